"""The exchange domain derived from the generated test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkbourse.functions.orders import stable_id
from sparkbourse.schemas import LEDGER, MONEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Deal rows to all cores. Few tasks read a compact table, but a row takes far longer to be made JSON and decoded than
    to be read."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders: even keys sell, odd keys buy; the market is the customer's nation and the order priority."""
    return _orders(spark, sf_dir, table(spark, sf_dir, "orders"))


def _orders(spark: SparkSession, sf_dir: str, o: DataFrame) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("o_orderkey")
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.cast("string").alias("id"),
            F.col("n_name").alias("baseAssetId"),
            F.col("o_orderpriority").alias("quoteAssetId"),
            F.col("o_custkey").cast("string").alias("walletId"),
            F.when(key % 2 == 0, "LIMIT_SELL").otherwise("LIMIT_BUY").alias("orderType"),
            F.round(F.col("o_totalprice") / 1000).cast(MONEY).alias("price"),
            (1 + key % 20).cast(MONEY).alias("qty"),
            F.lit(0).cast(MONEY).alias("qtyFilled"),
            F.when(F.col("o_orderstatus") == "O", "PROCESSED")
            .when(F.col("o_orderstatus") == "F", "FILLED")
            .otherwise("CONFIRMED")
            .alias("status"),
            F.lit("").alias("message"),
            key.alias("seq"),
        )
    )


def wallet_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wallet commands: one per event, on one of three assets named by the event's properties."""
    return _wallet_commands(table(spark, sf_dir, "events"))


def _wallet_commands(rows: DataFrame) -> DataFrame:
    amount = F.round(F.col("value") * 100).cast("bigint").cast(LEDGER)
    k = F.get_json_object("props", "$.k").cast("int")
    return rows.select(
        F.col("event_id").alias("seq"),
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("cause_"), F.col("event_id")).alias("causeId"),
        F.col("user_id").cast("string").alias("walletId"),
        F.concat(F.lit("asset_"), k % 3).alias("assetId"),
        F.when(F.col("event_type") == "signup", "CREDIT")
        .when(F.col("event_type") == "purchase", "DEBIT")
        .when(F.col("event_type") == "click", "BLOCK")
        .when(F.col("event_type") == "view", "RELEASE")
        .otherwise("RELEASE_AND_DEBIT")
        .alias("operation"),
        amount.alias("amount"),
        amount.alias("amountRelease"),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of the orders: confirmed, resting, then filled; every eleventh resting order is cancelled."""
    o = orders(spark, sf_dir)
    base = [c for c in o.columns if c not in ("status", "seq")]
    key, end = F.col("seq"), F.col("status")

    def change(step: int, status: str, deleted: bool = False):
        return F.struct(
            (key * 3 + step).alias("seq"), F.lit(status).alias("status"), F.lit(deleted).alias("is_delete")
        )

    steps = F.array_compact(
        F.array(
            change(0, "CONFIRMED"),
            F.when(end != "CONFIRMED", change(1, "PROCESSED")),
            F.when(end == "FILLED", change(2, "FILLED")),
            F.when((end == "PROCESSED") & (key % 11 == 0), change(2, "CANCELLED", True)),
        )
    )
    return o.select(*base, F.inline(steps))


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log as JSON text, some of it unreadable: order commands on even positions, wallet commands on odd ones."""
    o = _orders(spark, sf_dir, spread(table(spark, sf_dir, "orders"), "o_orderkey"))
    key = F.col("seq")
    order = [
        "id",
        "baseAssetId",
        "quoteAssetId",
        "walletId",
        F.when(key % 97 == 1, "MARKET").otherwise(F.col("orderType")).alias("orderType"),
        F.when(key % 97 == 4, 1e20).otherwise(F.col("price").cast("double")).alias("price"),
        F.col("qty").cast("double").alias("qty"),
    ]
    fresh = F.struct(*order)
    resting = F.struct(*order, F.lit("PROCESSED").alias("status"))
    end, to_match = F.col("status"), key % 5 == 4
    target = (key - key % 3).cast("string")

    def command(name: str, order_id, *more):
        return F.struct(
            F.concat(F.lit("cmd-"), F.col("id")).alias("id"),
            order_id.alias("orderId"),
            order_id.alias("causeId"),
            F.lit(name).alias("command"),
            *more,
        )

    submit = F.when(end == "CONFIRMED", command("SUBMIT", F.col("id"), fresh.alias("order")))
    cancel = F.when(end == "FILLED", command("CANCEL", target))
    fill = F.when(
        (end == "PROCESSED") & ~to_match,
        command(
            "FILL",
            F.col("id"),
            (1 + key % 15).cast("double").alias("fillQty"),
            F.col("price").cast("double").alias("fillPrice"),
        ),
    )
    match = F.when(
        (end == "PROCESSED") & to_match,
        F.struct(
            F.concat(F.lit("match-"), F.col("id")).alias("matchId"),
            resting.alias("leftOrder"),
            resting.alias("rightOrder"),
            F.col("qty").cast("double").alias("qtyFilled"),
            F.col("price").cast("double").alias("price"),
        ),
    )
    event_id = F.concat(F.lit("o-"), F.col("id"))
    parts = [
        event_id.alias("id"),
        match.alias("ordersMatchCommand"),
        F.when(fill.isNotNull(), resting).alias("order"),
    ]
    text = (
        F.when(submit.isNotNull(), F.to_json(F.struct(*parts, submit.alias("orderCommand"))))
        .when(cancel.isNotNull(), F.to_json(F.struct(*parts, cancel.alias("orderCommand"))))
        .otherwise(F.to_json(F.struct(*parts, fill.alias("orderCommand"))))
    )
    value = (
        F.when(key % 97 == 0, F.substring(text, 1, 20))
        .when(key % 97 == 2, F.to_json(F.struct(event_id.alias("id"))))
        .otherwise(text)
    )
    order_log = o.select((key * 2).alias("seq"), event_id.alias("key"), value.alias("value"))

    w = _wallet_commands(spread(table(spark, sf_dir, "events"), "event_id"))
    wallet_command = F.struct(
        "id",
        "causeId",
        "walletId",
        "assetId",
        F.when(F.col("seq") % 53 == 0, "MINT").otherwise(F.col("operation")).alias("operation"),
        F.col("amount").cast("double").alias("amount"),
        F.when(F.col("operation").startswith("RELEASE"), F.col("amountRelease").cast("double")).alias("amountRelease"),
    )
    wallet_event_id = F.concat(F.lit("w-"), F.col("id"))
    wallet_log = w.select(
        (F.col("seq") * 2 + 1).alias("seq"),
        wallet_event_id.alias("key"),
        F.to_json(F.struct(wallet_event_id.alias("id"), wallet_command.alias("walletCommand"))).alias("value"),
    )
    return order_log.unionByName(wallet_log)


def wallet_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wallet commands as JSON events."""
    w = _wallet_commands(spread(table(spark, sf_dir, "events"), "event_id"))
    command = F.struct(
        "id",
        "causeId",
        "walletId",
        "assetId",
        "operation",
        F.col("amount").cast("double").alias("amount"),
        F.col("amountRelease").cast("double").alias("amountRelease"),
    )
    event_id = F.concat(F.lit("w-"), F.col("id"))
    return w.select(
        event_id.alias("key"),
        F.to_json(F.struct(event_id.alias("id"), command.alias("walletCommand"))).alias("value"),
        "seq",
    )


def wallet_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funds to trade with: a hundred times the account balance in the base asset, some of every quote asset."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    quotes = [F.lit(q) for q in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]
    base = F.struct(F.col("n_name").alias("assetId"), (F.col("c_acctbal") * 100).cast(LEDGER).alias("amount"))
    rest = [F.struct(q.alias("assetId"), F.lit(25).cast(LEDGER).alias("amount")) for q in quotes]
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("walletId"),
        F.inline(F.array(base, *rest)),
        F.lit(0).cast(LEDGER).alias("blocked"),
    )


def clean_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log without faults: submits, cancels and fills of orders submitted shortly before in the same market, and
    deposits and withdrawals. A wallet trades in one market only."""
    o = orders(spark, sf_dir).withColumn("walletId", F.concat_ws("/", "walletId", "quoteAssetId"))
    key, event_id = F.col("seq"), F.concat(F.lit("o-"), F.col("id"))
    command_id = F.concat(F.lit("cmd-"), F.col("id"))
    fields = ["baseAssetId", "quoteAssetId", "walletId", "orderType", "price", "qty"]
    record = [*fields[:4], F.col("price").cast("double").alias("price"), F.col("qty").cast("double").alias("qty")]
    before = Window.partitionBy("baseAssetId", "quoteAssetId").orderBy("seq")

    def made(earlier: str) -> Column:
        """The id that an earlier order gets when it is submitted."""
        name, seq = F.col(f"{earlier}.id"), F.col(f"{earlier}.seq")
        return F.when(name.isNotNull(), stable_id(seq, F.concat(F.lit("o-"), name), F.concat(F.lit("cmd-"), name), name))

    # Of the orders before, what their ids are made of goes through the shuffle, not the ids.
    rows = o.select("seq", "id", *fields)
    rows = rows.withColumns({"two": F.lag(F.struct("id", "seq"), 2).over(before), "one": F.lag(F.struct("id", "seq", *record), 1).over(before)})
    resting = F.struct(made("one").alias("id"), *[F.col(f"one.{c}") for c in fields], F.lit("PROCESSED").alias("status"))
    rows = rows.withColumns({"two": made("two"), "one": F.when(F.col("one").isNotNull(), resting)})
    kind = (
        F.when((key % 7 == 3) & F.col("two").isNotNull(), "CANCEL")
        .when((key % 11 == 5) & F.col("one").isNotNull(), "FILL")
        .when(key % 13 == 7, "WALLET")
        .otherwise("SUBMIT")
    )
    rows = rows.withColumn("kind", kind)

    def command(order_id, *more):
        return F.struct(command_id.alias("id"), order_id.alias("orderId"), order_id.alias("causeId"), F.col("kind").alias("command"), *more)

    submit = command(F.col("id"), F.struct("id", *record).alias("order"))
    fill = command(F.col("one.id"), (1 + key % 4).cast("double").alias("fillQty"), F.col("one.price").alias("fillPrice"))
    wallet = F.struct(
        command_id.alias("id"),
        event_id.alias("causeId"),
        "walletId",
        F.when(key % 3 == 0, F.col("baseAssetId")).otherwise(F.col("quoteAssetId")).alias("assetId"),
        F.when(key % 2 == 0, "CREDIT").otherwise("DEBIT").alias("operation"),
        (1 + key % 50).cast("double").alias("amount"),
    )
    named = event_id.alias("id")
    value = (
        F.when(F.col("kind") == "CANCEL", F.to_json(F.struct(named, command(F.col("two")).alias("orderCommand"))))
        .when(F.col("kind") == "FILL", F.to_json(F.struct(named, F.col("one").alias("order"), fill.alias("orderCommand"))))
        .when(F.col("kind") == "WALLET", F.to_json(F.struct(named, wallet.alias("walletCommand"))))
        .otherwise(F.to_json(F.struct(named, submit.alias("orderCommand"))))
    )
    return rows.select(event_id.alias("key"), value.alias("value"), "seq")


def clean_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funds for the wallets of the clean log."""
    o = orders(spark, sf_dir).select("walletId", "baseAssetId", "quoteAssetId").distinct()
    customer = F.col("walletId").cast("bigint")
    base = F.struct(F.col("baseAssetId").alias("assetId"), (100 * (1 + customer % 40)).cast(LEDGER).alias("amount"))
    quote = F.struct(F.col("quoteAssetId").alias("assetId"), (5 + customer % 20).cast(LEDGER).alias("amount"))
    return o.select(F.concat_ws("/", "walletId", "quoteAssetId").alias("walletId"), F.inline(F.array(base, quote)), F.lit(0).cast(LEDGER).alias("blocked"))


def bare_log(spark: SparkSession, sf_dir: str, commands: bool) -> DataFrame:
    """Orders, or commands that carry them, as JSON records without an envelope; some broken, cut off or of unknown kind."""
    o, key = orders(spark, sf_dir), F.col("seq")
    order = F.struct(
        "id",
        "baseAssetId",
        "quoteAssetId",
        "walletId",
        F.when(~F.lit(commands) & (key % 89 == 7), "MARKET").otherwise(F.col("orderType")).alias("orderType"),
        F.col("price").cast("double").alias("price"),
        F.when(key % 4 > 0, F.col("qty").cast("double")).alias("qty"),
        F.when(key % 3 == 0, F.col("status")).alias("status"),
    )
    command = F.struct(
        F.concat(F.lit("cmd-"), F.col("id")).alias("id"),
        F.col("id").alias("orderId"),
        F.col("id").alias("causeId"),
        F.when(key % 89 == 7, "BUY").when(key % 2 == 0, "SUBMIT").otherwise("CANCEL").alias("command"),
        F.when(key % 2 == 0, order).alias("order"),
    )
    text = F.to_json(command if commands else order)
    # Two records in one text are not one.
    value = F.when(key % 89 == 5, F.substring(text, 1, 20)).when(key % 89 == 9, F.concat(text, F.lit(', "wallet": '), text)).otherwise(text)
    return o.select(F.col("id").alias("key"), value.alias("value"), "seq")
