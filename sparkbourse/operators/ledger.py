"""Wallet commands folded into balances with a funds check.

Commands of a (wallet, asset) act in ``seq`` order. A BLOCK or DEBIT that asks for more than is available is rejected
and changes nothing, so each decision depends on the ones before it; every other command is always accepted. Once the
decisions are known, balances are ordinary sums.

Deciding is the one sequential step. Keys of ordinary size are sorted and read through once by the task that owns
them. For larger keys the decisions are narrowed down in parallel first. With ``S`` the running sum of all effects as
if everything were accepted, a command is accepted exactly if ``u >= need``, where ``need = amount - S`` is known
beforehand and ``u`` starts at the funds of the key and only grows, by the amount of each rejected command. Whatever
needs no more than the funds at the start is settled without looking at the rest; what remains is read in bounded
slices, each starting from the ``u`` the previous one ended with.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbourse.operators.running import has_hot_key, max_group_rows, running_before
from sparkbourse.schemas import BLOCK, CREDIT, DEBIT, LEDGER, RELEASE, RELEASE_AND_DEBIT
from sparkbourse.session import stage

KEY = ["walletId", "assetId"]


def _zero() -> Column:
    return F.lit(0).cast(LEDGER)


def _effect(cases: dict[str, Column]) -> Column:
    operation = F.col("operation")
    effect = F.lit(None).cast(LEDGER)
    for name, value in cases.items():
        effect = F.when(operation == name, value.cast(LEDGER)).otherwise(effect)
    return F.coalesce(effect, _zero())


def amount_effect() -> Column:
    """Change of the amount held, if the command is accepted."""
    amount = F.col("amount")
    return _effect({CREDIT: amount, DEBIT: -amount, RELEASE_AND_DEBIT: -amount})


def blocked_effect() -> Column:
    """Change of the amount blocked, if the command is accepted."""
    release = -F.col("amountRelease")
    return _effect({BLOCK: F.col("amount"), RELEASE: release, RELEASE_AND_DEBIT: release})


def needs_funds() -> Column:
    return F.col("operation").isin(BLOCK, DEBIT)


def decide(commands: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Commands with ``accepted`` and, where rejected, ``availableFunds``; ``ledger`` holds the balances before.

    ``(walletId, assetId, seq)`` must be unique.
    """
    columns = commands.columns
    rows = commands.withColumns(
        {
            "_asks": F.when(needs_funds(), F.col("amount").cast(LEDGER)),
            "_effect": (amount_effect() - blocked_effect()).cast(LEDGER),
        }
    ).select(*columns, "_asks", "_effect")
    before = None
    if ledger is not None:
        free = (F.col("amount") - F.col("blocked")).cast(LEDGER)
        before = ledger.filter(" and ".join(f"{c} is not null" for c in KEY)).select(*KEY, free.alias("_funds"))

    if not has_hot_key(commands, KEY):
        return _read_through(rows, columns, before)
    rows = stage(rows, "commands")
    # There are at most (all rows / limit) hot keys.
    hot_keys = F.broadcast(rows.groupBy(*KEY).count().filter(F.col("count") > max_group_rows(rows)).select(*KEY))
    ordinary = _read_through(rows.join(hot_keys, KEY, "left_anti"), columns, before)
    hot = rows.join(hot_keys, KEY, "left_semi")
    hot = hot.withColumn("_funds", _zero()) if before is None else hot.join(before, KEY, "left").withColumn("_funds", F.coalesce("_funds", _zero()))
    return ordinary.unionByName(_decide_in_slices(hot, columns))


_EXACT = decimal.Context(prec=76)


def _read_through(rows: DataFrame, columns: list[str], before: DataFrame | None) -> DataFrame:
    """Decide every command of each key in one pass over the sorted partition; memory does not grow with the key.

    The funds ``before`` come as a row ahead of the commands, so that only one shuffle is needed.
    """
    schema = T.StructType(
        [
            *rows.select(*columns).schema.fields,
            T.StructField("accepted", T.BooleanType()),
            T.StructField("availableFunds", LEDGER),
        ]
    )
    none = decimal.Decimal(0)

    def decide_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, funds = None, none
        for batch in batches:
            accepted, shown = [], []
            for wallet, asset, start, asks, effect in zip(
                *(batch.column(c).to_pylist() for c in (*KEY, "_funds", "_asks", "_effect")), strict=True
            ):
                if (wallet, asset) != key:
                    key, funds = (wallet, asset), none
                if effect is None:
                    funds = funds if start is None else _EXACT.add(funds, start)
                elif asks is not None and funds < asks:
                    accepted.append(False)
                    shown.append(funds)
                else:
                    accepted.append(True)
                    shown.append(None)
                    funds = _EXACT.add(funds, effect)
            batch = batch.filter(batch.column("_effect").is_valid())
            arrays = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(accepted, pa.bool_()), pa.array(shown, pa.decimal128(36, 16))],
                names=[*columns, "accepted", "availableFunds"],
            )

    rows = rows.withColumns({"_effect": F.coalesce("_effect", _zero()), "_funds": F.lit(None).cast(LEDGER)})
    if before is not None:
        rows = rows.unionByName(before, allowMissingColumns=True)
    ordered = rows.repartition(*KEY).sortWithinPartitions(*KEY, F.col("_effect").isNotNull(), "seq")
    return ordered.mapInArrow(decide_batches, schema)


def _decide_in_slices(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Decide the commands of hot keys; see the module's description."""
    limit = max_group_rows(rows)
    summed = stage(
        running_before(rows, KEY, ["seq"], sums={"_sum": F.col("_effect")}, hot=True, label="effects"), "summed"
    )
    sum_type = summed.schema["_sum"].dataType
    # Negative amounts are not ruled out: rejecting one lowers `u`, so the bound allows for all of them.
    start = stage(
        summed.groupBy(*KEY).agg(
            F.min("_funds").cast(sum_type).alias("u"),
            F.coalesce(F.sum(F.least("_asks", _zero())), _zero()).cast(sum_type).alias("_slack"),
        ),
        "start",
    )
    open_rows = (
        summed.filter("_asks is not null")
        .select(*KEY, "seq", "_asks", (F.col("_asks") - F.col("_sum")).cast(sum_type).alias("need"))
        .join(start, KEY)
        .filter("need > u + _slack")
        .drop("u")
    )
    open_rows = stage(open_rows, "open")
    sliced = stage(
        running_before(open_rows, KEY, ["seq"], sums={"_no": F.lit(1).cast("long")}, label="slices").withColumn(
            "_slice", F.expr(f"_no div {limit}")
        ),
        "sliced",
    )
    last = sliced.agg(F.max("_slice")).first()[0]
    state, rejections = start.select(*KEY, "u"), None
    for number in range(0 if last is None else last + 1):
        waiting = sliced.filter(F.col("_slice") == number).join(state, KEY).filter("need > u + _slack")
        turned_down = stage(_rejections(waiting), "rejected")
        grown = turned_down.groupBy(*KEY).agg(F.sum("_asks").alias("_grown"))
        state = stage(
            state.join(grown, KEY, "left").select(
                *KEY, (F.col("u") + F.coalesce("_grown", _zero())).cast(sum_type).alias("u")
            ),
            "state",
        )
        rejections = turned_down if rejections is None else rejections.unionByName(turned_down)
    if rejections is None:
        return summed.select(*columns, F.lit(True).alias("accepted"), F.lit(None).cast(LEDGER).alias("availableFunds"))
    marked = summed.join(
        rejections.select(*KEY, "seq", F.col("u").alias("_u"), F.lit(True).alias("_rejected")), [*KEY, "seq"], "left"
    )
    return marked.select(
        *columns,
        F.col("_rejected").isNull().alias("accepted"),
        F.when(F.col("_rejected"), F.col("_u") + F.col("_sum")).cast(LEDGER).alias("availableFunds"),
    )


def _rejections(waiting: DataFrame) -> DataFrame:
    """Rejected ones among at most a slice of undecided commands per key, with ``u`` as it was."""
    columns = [*KEY, "seq", "_asks", "u"]

    def reject(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, u = None, None
        for batch in batches:
            picked, shown = [], []
            for i, (wallet, asset, start, asks, need) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in (*KEY, "u", "_asks", "need")), strict=True)
            ):
                if (wallet, asset) != key:
                    key, u = (wallet, asset), start
                if u < need:
                    picked.append(i)
                    shown.append(u)
                    u = _EXACT.add(u, asks)
            rows = batch.select(columns[:-1]).take(pa.array(picked, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(shown, batch.schema.field("u").type)], names=columns
            )

    ordered = waiting.repartition(*KEY).sortWithinPartitions(*KEY, "seq")
    return ordered.mapInArrow(reject, waiting.select(columns).schema)


def rejections(decided: DataFrame) -> DataFrame:
    """Commands turned down for lack of funds, with what was asked and what was there."""
    return decided.filter("not accepted").select(
        *KEY,
        "seq",
        "operation",
        F.lit("not enough funds").alias("reason"),
        F.col("amount").alias("required"),
        F.col("availableFunds").alias("available"),
    )


def running_balances(
    decided: DataFrame,
    ledger: DataFrame | None = None,
    order: Sequence[str] = ("seq",),
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per accepted command with the balance after it; ``order`` must be unique within a key."""
    accepted = decided.filter("accepted").withColumns(
        {"_amount": amount_effect(), "_blocked": blocked_effect()}
    )
    running = running_before(
        accepted,
        KEY,
        order,
        sums={"_amount_before": F.col("_amount"), "_blocked_before": F.col("_blocked"), "_tx": F.lit(1).cast("long")},
        label="balances",
    )
    amount, blocked, tx = _zero(), _zero(), F.lit(0).cast("long")
    if ledger is not None:
        seeds = ledger.select(
            *KEY, F.col("amount").alias("_a"), F.col("blocked").alias("_b"), F.col("txCount").alias("_t")
        )
        running = running.join(seeds, KEY, "left")
        amount, blocked, tx = F.coalesce("_a", amount), F.coalesce("_b", blocked), F.coalesce("_t", tx)
    return running.select(
        *KEY,
        "seq",
        "operation",
        *carry,
        (F.col("_amount_before").cast(LEDGER) + F.col("_amount") + amount).cast(LEDGER).alias("balance"),
        (F.col("_blocked_before").cast(LEDGER) + F.col("_blocked") + blocked).cast(LEDGER).alias("blockedBalance"),
        (F.col("_tx") + 1 + tx).cast("long").alias("txCount"),
    )


def effects(decided: DataFrame) -> DataFrame:
    """Total change per key. Rejected commands change nothing but make the wallet known."""
    ok = F.col("accepted")
    return decided.groupBy(*KEY).agg(
        F.sum(F.when(ok, amount_effect()).otherwise(_zero())).cast(LEDGER).alias("amount"),
        F.sum(F.when(ok, blocked_effect()).otherwise(_zero())).cast(LEDGER).alias("blocked"),
        F.sum(ok.cast("long")).alias("txCount"),
        F.max(ok).alias("held"),
    )


def apply_effects(ledger: DataFrame | None, *changes: DataFrame) -> DataFrame:
    """Ledger rows after adding changes to them."""
    columns = [*KEY, "amount", "blocked", "txCount", "held"]
    parts = [*([] if ledger is None else [ledger]), *changes]
    total = parts[0].select(columns)
    for part in parts[1:]:
        total = total.unionByName(part.select(columns))
    return total.groupBy(*KEY).agg(
        F.sum("amount").cast(LEDGER).alias("amount"),
        F.sum("blocked").cast(LEDGER).alias("blocked"),
        F.sum("txCount").alias("txCount"),
        F.max("held").alias("held"),
    )


def after_moves(ledger: DataFrame, decided: DataFrame) -> DataFrame:
    """Ledger rows of the keys that decided commands are about, after them; rejected ones make the wallet known."""
    ok, columns = F.col("accepted"), [*KEY, "amount", "blocked", "txCount", "held"]
    changes = decided.select(
        *KEY,
        F.when(ok, amount_effect()).otherwise(_zero()).alias("amount"),
        F.when(ok, blocked_effect()).otherwise(_zero()).alias("blocked"),
        ok.cast("long").alias("txCount"),
        ok.alias("held"),
        F.lit(True).alias("_named"),
    )
    rows = changes.unionByName(ledger.select(*columns, F.lit(False).alias("_named")))
    total = rows.groupBy(*KEY).agg(
        F.sum("amount").cast(LEDGER).alias("amount"),
        F.sum("blocked").cast(LEDGER).alias("blocked"),
        F.sum("txCount").alias("txCount"),
        F.max("held").alias("held"),
        F.max("_named").alias("_named"),
    )
    return total.filter("_named").drop("_named")


def fold(commands: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Ledger after all commands."""
    return apply_effects(ledger, effects(decide(commands, ledger)))


def tx_count(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("walletId").agg(F.sum("txCount").alias("txCount"))


def touch_wallets(commands: DataFrame) -> DataFrame:
    """Wallets seen in commands, known from then on even if nothing was accepted."""
    return commands.select("walletId").distinct()


def fill_effects(wallet_commands: DataFrame) -> DataFrame:
    """Change per key of fills. They are never rejected, so their order does not matter and sums are enough."""
    return effects(wallet_commands.withColumn("accepted", F.lit(True)))
