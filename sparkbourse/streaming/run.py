"""Continuous processing of an event log.

Each micro-batch becomes the version after the last one. A version carries the log positions it covers, and only records
that no committed version covers are processed, so every event takes effect exactly once: a batch that failed is run
again as the same version, one that is already committed is left alone, and after a lost checkpoint, when all that ever
arrived is delivered again, what is new among it still counts. Ids follow from the data, so a repeated batch is the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkbourse.operators import ledger
from sparkbourse.plans.settle import FUNDING, commit_batch, deposits, wallet_changes
from sparkbourse.schemas import MONEY
from sparkbourse.session import stage, temporary
from sparkbourse.sources.codec import decode_events, only_needed, split_corrupt
from sparkbourse.sources.events import LOG
from sparkbourse.sources.state import StateStore


def run_versions(
    records: DataFrame,
    store: StateStore,
    checkpoint: str,
    commit: Callable[[StateStore, DataFrame, int], None],
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that commits what is new in every micro-batch of ``records`` as the next version."""

    def process(batch: DataFrame, batch_id: int) -> None:
        fresh = store.uncovered(batch)
        if fresh is not None:
            commit(store, fresh, (store.latest() or 0) + 1)

    writer = records.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_orders(
    records: DataFrame,
    store: StateStore,
    checkpoint: str,
    available_now: bool = True,
    time_priority: bool = False,
) -> StreamingQuery:
    """Order processing: the same batches as in a replay, one per trigger."""

    def commit(target: StateStore, batch: DataFrame, version: int) -> None:
        commit_batch(target, batch, version, time_priority)

    return run_versions(records, store, checkpoint, commit, available_now)


def run_ledger(records: DataFrame, store: StateStore, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Wallet commands only: balances kept up to date without any order processing."""
    return run_versions(records, store, checkpoint, commit_wallet_commands, available_now)


def commit_wallet_commands(store: StateStore, raw: DataFrame, version: int) -> None:
    with temporary():
        good, dead = split_corrupt(stage(only_needed(decode_events(raw.select(*LOG.fieldNames()))), "decoded"))
        wallets = store.load("wallets", version - 1)
        moves = deposits(good).withColumns({"phase": F.lit(FUNDING), "nth": F.lit(0).cast(MONEY)})
        decided = stage(ledger.decide(moves, wallets), "decided")
        effects = ledger.effects(decided)
        touched = wallets.join(effects.select(*ledger.KEY), ledger.KEY, "left_semi")
        store.commit(
            version,
            {"wallets": ledger.apply_effects(touched, effects).withColumn("is_delete", F.lit(False))},
            {
                "wallet_changes": wallet_changes(decided, wallets),
                "rejections": ledger.rejections(decided),
                "dead_letters": dead,
            },
            raw,
        )


def fresh_start(spark: SparkSession, root: str, compact_every: int = 10) -> StateStore:
    """State in a new folder, to process a log again from its beginning; the old folder is left as it is."""
    store = StateStore(spark, root, compact_every)
    if store.latest() is not None:
        raise ValueError(f"{root} already holds state; give a new folder")
    store.seed()
    return store
