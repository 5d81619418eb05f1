"""Every registered query: ``(spark, folder with the test tables) -> DataFrame``."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbourse.functions import orders as fn
from sparkbourse.functions import wallets
from sparkbourse.operators import ledger, lifecycle, matching, route, sequential
from sparkbourse.plans import oracles, queries, settle
from sparkbourse.schemas import MONEY, ORDER_STATE
from sparkbourse.session import COMPRESSION, scratch_dir, stage
from sparkbourse.sources import codec, events, tables, testviews
from sparkbourse.sources.state import StateStore, seed_wallets, upsert
from sparkbourse.streaming import feeds, run, stateful

Query = Callable[[SparkSession, str], DataFrame]


def _snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def out(df: DataFrame, *columns: str) -> DataFrame:
    """Result columns in snake case, decimals as doubles."""
    df = df.select(*columns) if columns else df
    return df.select(
        *[
            (F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)).alias(
                _snake(f.name)
            )
            for f in df.schema.fields
        ]
    )


def _matches(spark: SparkSession, d: str) -> DataFrame:
    orders = testviews.orders(spark, d)
    return matching.match_snapshot(matching.takers(orders), orders)


def _fills(spark: SparkSession, d: str) -> DataFrame:
    # Each match yields fills on both sides under one position, taken from the taker.
    matches = _matches(spark, d)
    return matching.to_fills(matches.withColumns({"seq": F.col("takerId").cast("long"), "eventId": F.col("takerId")}))


def match_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return out(
        _matches(spark, d), "takerId", "makerId", "baseAssetId", "quoteAssetId", "qtyFilled", "price", "qtyBefore"
    )


def match_fills(spark: SparkSession, d: str) -> DataFrame:
    return out(
        _fills(spark, d).select(
            "commandId", "orderId", "causeId", "command", "order.walletId", "order.orderType", "fillQty", "fillPrice"
        )
    )


def trade_totals(spark: SparkSession, d: str) -> DataFrame:
    return out(queries.trade_totals(_matches(spark, d)))


def order_book_l3(spark: SparkSession, d: str) -> DataFrame:
    return out(queries.order_book_l3(testviews.orders(spark, d)))


def order_book_l2(spark: SparkSession, d: str) -> DataFrame:
    return out(queries.order_book_l2(testviews.orders(spark, d)))


def markets(spark: SparkSession, d: str) -> DataFrame:
    return out(queries.markets(testviews.orders(spark, d)))


def ticker(spark: SparkSession, d: str) -> DataFrame:
    orders = testviews.orders(spark, d)
    trades = matching.match_snapshot(matching.takers(orders), orders)
    return out(queries.ticker(orders, trades, F.struct(F.col("takerId").cast("long"), "qtyBefore")))


def order_status(spark: SparkSession, d: str) -> DataFrame:
    return out(queries.order_status(testviews.orders(spark, d), oracles.ORDER_ID))


def orders_for_market(spark: SparkSession, d: str) -> DataFrame:
    return out(queries.orders_for_market(testviews.orders(spark, d), oracles.BASE, oracles.QUOTE))


def order_history(spark: SparkSession, d: str) -> DataFrame:
    history = queries.order_history(testviews.order_changes(spark, d))
    return out(history, "id", "seq", "previousStatus", "status", "qty")


def latest_by_key(spark: SparkSession, d: str) -> DataFrame:
    return out(tables.orders(testviews.order_changes(spark, d)))


def snapshot_asof(spark: SparkSession, d: str) -> DataFrame:
    changes = testviews.order_changes(spark, d)
    return out(tables.snapshot_asof(changes, ["id"], oracles.ASOF_SEQ), *tables.ORDER_COLUMNS)


def subscription_updates(spark: SparkSession, d: str) -> DataFrame:
    updates = queries.order_updates(testviews.order_changes(spark, d), _subscriptions(spark, d))
    return out(updates, "id", "seq", "status", "feedId")


def _subscriptions(spark: SparkSession, d: str) -> DataFrame:
    """Subscribers are the wallets of wealthy customers; each follows all of its orders."""
    rich = testviews.table(spark, d, "customer").filter(F.col("c_acctbal") > oracles.MIN_BALANCE)
    own = testviews.orders(spark, d).join(rich, F.col("walletId") == F.col("c_custkey").cast("string"), "left_semi")
    return queries.subscribe(own.select(F.col("id").alias("orderId"), F.col("seq").alias("requestId")))


def snapshot_plus_updates(spark: SparkSession, d: str) -> DataFrame:
    changes = testviews.order_changes(spark, d)
    snapshot = tables.snapshot_asof(changes, ["id"], oracles.ASOF_SEQ)
    return out(queries.snapshot_then_updates(snapshot, changes, oracles.ASOF_SEQ), "id", "status", "kind")


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    return ledger.fold(testviews.wallet_commands(spark, d))


def _decided(spark: SparkSession, d: str) -> DataFrame:
    commands = testviews.wallet_commands(spark, d)
    return ledger.decide(commands.select("walletId", "assetId", "seq", "operation", "amount", "amountRelease"))


def wallet_ledger(spark: SparkSession, d: str) -> DataFrame:
    return out(_ledger(spark, d), "walletId", "assetId", "amount", "blocked", "txCount")


def wallet_running_balance(spark: SparkSession, d: str) -> DataFrame:
    return out(ledger.running_balances(_decided(spark, d)))


def wallet_rejections(spark: SparkSession, d: str) -> DataFrame:
    return out(
        ledger.rejections(_decided(spark, d)), "walletId", "assetId", "seq", "operation", "required", "available"
    )


def wallet_balances(spark: SparkSession, d: str) -> DataFrame:
    return out(wallets.balances(wallets.as_map(_ledger(spark, d))))


def wallet_tx_count(spark: SparkSession, d: str) -> DataFrame:
    return out(ledger.tx_count(_ledger(spark, d)))


def wallet_assets_map(spark: SparkSession, d: str) -> DataFrame:
    """Wallet records: what each holds of every asset, zero where it has none."""
    records = wallets.as_map(_ledger(spark, d))
    held = [
        wallets.asset_or_zero(F.col("assets"), F.lit(f"asset_{i}"))[part].alias(f"{part}_{i}")
        for i in range(3)
        for part in ("amount", "blocked")
    ]
    return out(records.select("walletId", F.size("assets").cast("long").alias("assets"), *held, "txCount"))


def wallets_table(spark: SparkSession, d: str) -> DataFrame:
    """The WALLETS table written out and queried by name."""
    tables.materialize(tables.wallets(_ledger(spark, d)), _scratch(spark, "wallets"), "QUERYABLE_WALLETS")
    return out(
        spark.sql(
            "SELECT walletId, assetId, asset.amount, asset.blocked "
            "FROM QUERYABLE_WALLETS LATERAL VIEW explode(assets) a AS assetId, asset"
        )
    )


def order_block_amounts(spark: SparkSession, d: str) -> DataFrame:
    return out(
        testviews.orders(spark, d).select(
            "id",
            fn.market().alias("market"),
            fn.counter_side(F.col("orderType")).alias("counterSide"),
            fn.asset_to_block().alias("assetToBlock"),
            fn.amount_to_block().alias("amountToBlock"),
            fn.asset_to_credit().alias("assetToCredit"),
        )
    )


def fill_wallet_commands(spark: SparkSession, d: str) -> DataFrame:
    return out(
        lifecycle.to_wallet_commands(_fills(spark, d)),
        "id",
        "causeId",
        "walletId",
        "assetId",
        "operation",
        "amount",
        "amountRelease",
    )


def confirm_fills(spark: SparkSession, d: str) -> DataFrame:
    return out(lifecycle.confirm_fills(lifecycle.to_wallet_commands(_fills(spark, d))))


def fill_effects(spark: SparkSession, d: str) -> DataFrame:
    return out(ledger.fill_effects(lifecycle.to_wallet_commands(_fills(spark, d)))).drop("held")


def apply_fills(spark: SparkSession, d: str) -> DataFrame:
    """Orders after the fills of matching in turn."""
    orders = testviews.orders(spark, d)
    matches = sequential.match_sequential(matching.takers(orders), orders).withColumn("eventId", F.col("takerId"))
    return out(lifecycle.apply_fills(matching.enter_book(orders), matching.to_fills(matches)), "id", "qty", "qtyFilled", "status")


def _decoded(spark: SparkSession, d: str) -> DataFrame:
    return codec.decode_events(testviews.raw_log(spark, d))


def _events(spark: SparkSession, d: str) -> DataFrame:
    return codec.split_corrupt(_decoded(spark, d))[0]


def decode_events(spark: SparkSession, d: str) -> DataFrame:
    e = "event."
    return out(
        _events(spark, d).select(
            "seq",
            F.col(e + "id").alias("eventId"),
            route.content().alias("content"),
            F.col(e + "orderCommand.command").alias("command"),
            F.col(e + "orderCommand.orderId").alias("orderId"),
            F.col(e + "orderCommand.order.price").alias("price"),
            F.col(e + "orderCommand.fillQty").alias("fillQty"),
            F.col(e + "walletCommand.operation").alias("operation"),
            F.col(e + "walletCommand.amount").alias("amount"),
            F.col(e + "walletCommand.amountRelease").alias("amountRelease"),
        )
    )


def encode_events(spark: SparkSession, d: str) -> DataFrame:
    """Events written as JSON and read back."""
    text = codec.encode_events(_events(spark, d).select("seq", "event"))
    again = codec.split_corrupt(codec.decode_events(text))[0]
    return out(
        again.select(
            "seq",
            F.col("event.id").alias("eventId"),
            route.content().alias("content"),
            F.col("event.orderCommand.command").alias("command"),
            F.col("event.walletCommand.amount").alias("amount"),
        )
    )


def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    return out(codec.split_corrupt(_decoded(spark, d))[1], "seq", "reason")


def route_events(spark: SparkSession, d: str) -> DataFrame:
    return out(
        _events(spark, d).select(
            "seq",
            route.content().alias("content"),
            route.requires_order_processing().alias("needsOrderProcessing"),
            F.col("event.orderCommand").isNotNull().alias("toOrderCommands"),
            F.col("event.walletCommand").isNotNull().alias("toWalletCommands"),
        )
    )


def decode_commands(spark: SparkSession, d: str) -> DataFrame:
    """Commands that came without an envelope."""
    decoded = codec.decode_commands(testviews.bare_log(spark, d, commands=True))
    fields = [F.when(F.col("reason").isNull(), F.col(f"event.orderCommand.{c}")).alias(a) for c, a in (("id", "commandId"), ("command", "command"), ("fillQty", "fillQty"), ("order.qty", "qty"))]
    return out(decoded.select("seq", "reason", *fields))


def decode_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders that came without an envelope."""
    decoded = codec.decode_orders(testviews.bare_log(spark, d, commands=False))
    fields = [F.when(F.col("reason").isNull(), F.col(f"event.order.{c}")).alias(c) for c in ("id", "walletId", "price", "qty", "status")]
    return out(decoded.select("seq", "reason", *fields))


def partition_keys(spark: SparkSession, d: str) -> DataFrame:
    return out(route.split_unkeyed(_events(spark, d))[0], "seq", "orderKey", "walletKey")


def unkeyed_events(spark: SparkSession, d: str) -> DataFrame:
    return out(route.split_unkeyed(_events(spark, d))[1], "seq", "reason")


def _commands(spark: SparkSession, d: str) -> DataFrame:
    """Order commands of the log, written out because checking reads them several times."""
    return stage(lifecycle.commands_of(_events(spark, d)), "commands")


def validate_submit(spark: SparkSession, d: str) -> DataFrame:
    valid = lifecycle.validate_submit(_commands(spark, d))
    return out(
        valid.select(
            "seq",
            "commandId",
            F.col("order.id").alias("orderId"),
            fn.market("order").alias("market"),
            "order.walletId",
            "order.price",
            "order.qty",
        )
    )


def validate_cancel(spark: SparkSession, d: str) -> DataFrame:
    valid = lifecycle.validate_cancel(_commands(spark, d), testviews.orders(spark, d))
    return out(valid.select("seq", "commandId", "orderId", "order.walletId", "order.status"))


def cancel_rejects(spark: SparkSession, d: str) -> DataFrame:
    checked = lifecycle.check_cancels(_commands(spark, d), testviews.orders(spark, d))
    return out(lifecycle.rejected(checked), "seq", "commandId", "orderId", "reason")


def validate_fill(spark: SparkSession, d: str) -> DataFrame:
    valid = lifecycle.validate_fill(_commands(spark, d))
    return out(valid.select("seq", "commandId", "orderId", "fillQty", "order.qty"))


def command_wallet_commands(spark: SparkSession, d: str) -> DataFrame:
    valid = lifecycle.valid(lifecycle.check(_commands(spark, d), testviews.orders(spark, d)))
    return out(
        lifecycle.to_wallet_commands(valid),
        "id",
        "causeId",
        "walletId",
        "assetId",
        "operation",
        "amount",
        "amountRelease",
    )


def apply_cancel(spark: SparkSession, d: str) -> DataFrame:
    orders = testviews.orders(spark, d)
    cancelled, remaining = lifecycle.apply_cancel(orders, lifecycle.validate_cancel(_commands(spark, d), orders))
    return out(
        cancelled.select("id", "seq", "status", F.lit(True).alias("isDelete")).unionByName(
            remaining.select("id", "seq", "status", F.lit(False).alias("isDelete"))
        )
    )


def apply_submit(spark: SparkSession, d: str) -> DataFrame:
    confirmed = lifecycle.apply_submit(lifecycle.validate_submit(_commands(spark, d)))
    return out(confirmed, "seq", "id", "walletId", "price", "qty", "status")


def api_commands(spark: SparkSession, d: str) -> DataFrame:
    """Requests stamped with ids: submits of the confirmed orders, cancels of the filled ones."""
    return out(_api_commands(spark, d), "commandId", "orderId", "causeId", "command")


def _api_commands(spark: SparkSession, d: str) -> DataFrame:
    orders = testviews.orders(spark, d).withColumn("requestId", F.concat(F.lit("r-"), F.col("id")))
    requests = orders.filter("status = 'CONFIRMED'").select(
        "requestId",
        "seq",
        F.lit("SUBMIT").alias("command"),
        F.lit(0).cast(MONEY).alias("fillQty"),
        F.lit(0).cast(MONEY).alias("fillPrice"),
        codec.order_struct().alias("commandOrder"),
    )
    cancelling = orders.filter("status = 'FILLED'")
    cancels = lifecycle.build_cancel(cancelling.withColumnRenamed("id", "orderId")).join(
        cancelling.select(F.col("id").alias("orderId"), "seq"), "orderId"
    )
    return lifecycle.stamp_submit(requests).drop("requestId").unionByName(cancels)


def command_log(spark: SparkSession, d: str) -> DataFrame:
    """The stamped commands appended to a log and read back."""
    path = _scratch(spark, "command-log")
    events.append_commands(_api_commands(spark, d), path)
    good = codec.split_corrupt(codec.decode_events(events.read_events(spark, path)))[0]
    return out(
        good.select("seq", "key", F.col("event.orderCommand.id").alias("commandId"), "event.orderCommand.command")
    )


def print_log(spark: SparkSession, d: str) -> DataFrame:
    return out(events.print_log(testviews.raw_log(spark, d)), "seq", "key")


def merged_logs(spark: SparkSession, d: str) -> DataFrame:
    """Two logs read as one source."""
    first, second = _scratch(spark, "log-a"), _scratch(spark, "log-b")
    testviews.raw_log(spark, d).select(*events.LOG.fieldNames()).write.parquet(first)
    testviews.wallet_log(spark, d).select(*events.LOG.fieldNames()).write.parquet(second)
    both = events.read_events(spark, [first, second])
    return out(both.select(events.place_in_source(F.col("seq")).alias("seq"), "key"))


def materialized_orders(spark: SparkSession, d: str) -> DataFrame:
    """The ORDERS table written out and queried by name."""
    current = tables.orders(testviews.order_changes(spark, d))
    tables.materialize(current, _scratch(spark, "orders"), "QUERYABLE_ORDERS")
    return out(spark.sql("SELECT * FROM QUERYABLE_ORDERS WHERE baseAssetId = :base", args={"base": oracles.BASE}))


def state_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The book after the changes that followed it."""
    book = testviews.orders(spark, d).filter("status = 'PROCESSED'").select("id", "status")
    changes = testviews.order_changes(spark, d).filter("status in ('FILLED', 'CANCELLED')")
    return out(upsert(book, changes.select("id", "status", "is_delete"), ["id"]))


def touch_wallets(spark: SparkSession, d: str) -> DataFrame:
    return out(ledger.touch_wallets(testviews.wallet_commands(spark, d)))


def seeded_wallets(spark: SparkSession, d: str) -> DataFrame:
    """Wallets funded in bulk, as records."""
    records = wallets.as_map(seed_wallets(testviews.wallet_seeds(spark, d)))
    entries = records.select("walletId", "txCount", F.explode("assets").alias("assetId", "asset"))
    return out(entries.select("walletId", "assetId", "asset.amount", "asset.blocked", "txCount"))


_IN_TURN = ["seq", "takerId", "makerId", "makerQty", "qtyFilled", "price", "qtyBefore"]


def match_sequential(spark: SparkSession, d: str) -> DataFrame:
    orders = testviews.orders(spark, d)
    return out(sequential.match_sequential(matching.takers(orders), orders), *_IN_TURN)


def match_sequential_by_age(spark: SparkSession, d: str) -> DataFrame:
    """Makers at one price by age instead of id."""
    orders = testviews.orders(spark, d)
    return out(sequential.match_sequential(matching.takers(orders), orders, time_priority=True), *_IN_TURN)


def settle_batch(spark: SparkSession, d: str) -> DataFrame:
    """The whole log as one batch against the open orders; the changed orders."""
    book = testviews.orders(spark, d).filter("status = 'PROCESSED'")
    log = codec.split_corrupt(stage(codec.only_needed(_decoded(spark, d)), "decoded"))[0]
    settled = settle.settle_batch(log, book, seed_wallets(testviews.wallet_seeds(spark, d)))
    return out(settled.order_delta, "id", "walletId", "orderType", "price", "qty", "qtyFilled", "status", "is_delete")


def _settled_clean(spark: SparkSession, d: str) -> settle.Settled:
    """The clean log as one batch on an empty book."""
    log = codec.split_corrupt(stage(codec.only_needed(codec.decode_events(testviews.clean_log(spark, d))), "decoded"))[0]
    book = spark.createDataFrame([], ORDER_STATE)
    return settle.settle_batch(log, book, seed_wallets(testviews.clean_seeds(spark, d)))


_ORDER_ROW = ["id", "walletId", "orderType", "price", "qty", "qtyFilled", "status", "seq"]


def settle_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders after the clean log."""
    return out(_settled_clean(spark, d).order_delta.filter("not is_delete"), *_ORDER_ROW)


def settle_wallets(spark: SparkSession, d: str) -> DataFrame:
    """Wallets after the clean log, untouched ones too."""
    seeds = seed_wallets(testviews.clean_seeds(spark, d))
    after = upsert(seeds, _settled_clean(spark, d).wallet_delta, ledger.KEY)
    return out(after, "walletId", "assetId", "amount", "blocked", "txCount")


def settle_rejections(spark: SparkSession, d: str) -> DataFrame:
    return out(_settled_clean(spark, d).rejections, "seq", "reason", "available")


def settle_matches(spark: SparkSession, d: str) -> DataFrame:
    return out(_settled_clean(spark, d).matches, *_IN_TURN)


def settle_changes(spark: SparkSession, d: str) -> DataFrame:
    """Every status that the orders of the clean log go through."""
    return out(_settled_clean(spark, d).order_changes, "seq", "id", "status", "qty", "qtyFilled")


def settle_streamed(spark: SparkSession, d: str) -> DataFrame:
    """The clean log streamed through order processing in two micro-batches; all orders after it."""
    log, root = _scratch(spark, "clean-log"), _scratch(spark, "settled")
    files = _write_parts(stage(testviews.clean_log(spark, d).select(*events.LOG.fieldNames()), "log"), log, 2)
    store = StateStore(spark, f"{root}/state")
    store.seed(wallets=seed_wallets(testviews.clean_seeds(spark, d)))
    records = events.read_events(spark, log, streaming=True, max_files=files)
    run.run_orders(records, store, f"{root}/checkpoint").awaitTermination()
    return out(store.load("orders"), *_ORDER_ROW)


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: A micro-batch reads as many files as a part of a log has: at least so many, and one for every so many rows, so that
#: a larger log is written and decoded by more tasks.
PART_FILES, FILE_ROWS = 4, 100_000


def _write_parts(log: DataFrame, path: str, parts: int) -> int:
    """Write a log in ``parts`` that follow each other in ``seq`` and in age; the number of files of each."""
    low, high, rows = log.agg(F.min("seq"), F.max("seq"), F.count("*")).first()
    step, files = (high - low) // parts + 1, max(PART_FILES, -(-rows // (parts * FILE_ROWS)))
    for start in range(low, high + 1, step):
        log.filter(F.col("seq").between(start, start + step - 1)).repartition(files).write.mode("append").parquet(path, compression=COMPRESSION)
    return files


def stream_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Wallet commands streamed in three micro-batches."""
    log, root = _scratch(spark, "wallet-log"), _scratch(spark, "ledger")
    files = _write_parts(testviews.wallet_log(spark, d), log, 3)
    store = run.fresh_start(spark, f"{root}/state")
    records = events.read_events(spark, log, streaming=True, max_files=files)
    run.run_ledger(records, store, f"{root}/checkpoint").awaitTermination()
    return out(store.load("wallets"), "walletId", "assetId", "amount", "blocked", "txCount")


def stateful_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Wallet commands streamed in three micro-batches through a stateful operator; the last change of each balance."""
    log, root = _scratch(spark, "wallet-log"), _scratch(spark, "stateful")
    files = _write_parts(testviews.wallet_log(spark, d), log, 3)
    records = events.read_events(spark, log, streaming=True, max_files=files)
    stateful.run_stateful_ledger(records, f"{root}/changes", f"{root}/checkpoint").awaitTermination()
    return out(stateful.balances(spark.read.schema(stateful.CHANGES).parquet(f"{root}/changes")))


def stream_settle(spark: SparkSession, d: str) -> DataFrame:
    """The whole log streamed through order processing in two micro-batches; all orders after it."""
    log, root = _scratch(spark, "order-log"), _scratch(spark, "orders")
    files = _write_parts(testviews.raw_log(spark, d).select(*events.LOG.fieldNames()), log, 2)
    store = StateStore(spark, f"{root}/state")
    book = testviews.orders(spark, d).filter("status = 'PROCESSED'")
    store.seed(book, seed_wallets(testviews.wallet_seeds(spark, d)))
    records = events.read_events(spark, log, streaming=True, max_files=files)
    run.run_orders(records, store, f"{root}/checkpoint").awaitTermination()
    return out(store.load("orders"), "id", "walletId", "orderType", "price", "qty", "qtyFilled", "status")


def stream_order_changes(spark: SparkSession, d: str) -> DataFrame:
    """Updates of subscribed orders from a stream of changes."""
    log, root = _scratch(spark, "changes"), _scratch(spark, "feed")
    changes = testviews.order_changes(spark, d).select("id", "seq", "status")
    files = _write_parts(changes, log, 2)
    subscriptions = stage(_subscriptions(spark, d), "subscriptions")
    arriving = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", files).parquet(log)
    feeds.subscribed_changes(
        arriving, lambda _: subscriptions, f"{root}/out", f"{root}/checkpoint"
    ).awaitTermination()
    return out(spark.read.parquet(f"{root}/out"), "id", "seq", "status", "feedId")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        match_snapshot,
        match_fills,
        trade_totals,
        order_book_l3,
        order_book_l2,
        markets,
        ticker,
        order_status,
        orders_for_market,
        order_history,
        latest_by_key,
        snapshot_asof,
        subscription_updates,
        snapshot_plus_updates,
        wallet_ledger,
        wallet_running_balance,
        wallet_rejections,
        wallet_balances,
        wallet_tx_count,
        wallet_assets_map,
        wallets_table,
        order_block_amounts,
        fill_wallet_commands,
        confirm_fills,
        fill_effects,
        apply_fills,
        decode_events,
        decode_commands,
        decode_orders,
        encode_events,
        dead_letters,
        route_events,
        partition_keys,
        unkeyed_events,
        validate_submit,
        validate_cancel,
        cancel_rejects,
        validate_fill,
        command_wallet_commands,
        apply_cancel,
        apply_submit,
        api_commands,
        command_log,
        print_log,
        merged_logs,
        materialized_orders,
        state_upsert,
        touch_wallets,
        seeded_wallets,
        match_sequential,
        match_sequential_by_age,
        settle_batch,
        settle_orders,
        settle_wallets,
        settle_rejections,
        settle_matches,
        settle_changes,
        settle_streamed,
        stream_ledger,
        stateful_ledger,
        stream_settle,
        stream_order_changes,
    )
}
