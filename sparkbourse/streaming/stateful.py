"""The wallet ledger as a stateful stream operator: balances live in Spark's state store, not in tables.

The balance of each (wallet, asset) is an entry of a map state that RocksDB keeps, checkpoints and restores. The keys of
``transformWithState`` are buckets of such pairs, since a call per pair costs far more than its few commands. A micro-batch
touches the entries it brings commands for and no other state, whatever the size of the ledger.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sparkbourse.operators.ledger import KEY, amount_effect, blocked_effect, needs_funds
from sparkbourse.plans.settle import deposits
from sparkbourse.schemas import LEDGER
from sparkbourse.sources.codec import decode_events, split_corrupt
from sparkbourse.sources.events import LOG

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: One row per command: what it did, or what was available when it was turned down, and the balance after it.
CHANGES = T.StructType(
    [
        T.StructField("walletId", T.StringType()),
        T.StructField("assetId", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("accepted", T.BooleanType()),
        T.StructField("availableFunds", LEDGER),
        T.StructField("amount", LEDGER),
        T.StructField("blocked", LEDGER),
        T.StructField("txCount", T.LongType()),
    ]
)
_ENTRY = T.StructType([T.StructField("walletId", T.StringType()), T.StructField("assetId", T.StringType())])
_STATE = T.StructType(
    [T.StructField("amount", T.StringType()), T.StructField("blocked", T.StringType()), T.StructField("txCount", T.LongType())]
)
_EXACT = decimal.Context(prec=60)
#: (wallet, asset) pairs are dealt to so many calls of a micro-batch. Part of the state's layout: a checkpoint keeps it.
BUCKETS = 1024


class Balances(StatefulProcessor):
    """Commands of a bucket of (wallet, asset) pairs, those of a pair in ``seq`` order within a micro-batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._balances = handle.getMapState("balances", _ENTRY, _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        commands = pd.concat(list(rows)).sort_values([*KEY, "seq"])
        pair, amount, blocked, count, done = None, None, None, 0, []
        for wallet, asset, seq, asks, more, block in commands[[*KEY, "seq", "asks", "more", "block"]].itertuples(index=False):
            if (wallet, asset) != pair:
                if pair is not None:
                    self._balances.updateValue(pair, (str(amount), str(blocked), count))
                pair = (wallet, asset)
                kept = self._balances.getValue(pair) or ("0", "0", 0)
                amount, blocked, count = decimal.Decimal(kept[0]), decimal.Decimal(kept[1]), kept[2]
            free = _EXACT.subtract(amount, blocked)
            accepted = pd.isna(asks) or asks <= free
            if accepted:
                amount, blocked, count = _EXACT.add(amount, more), _EXACT.add(blocked, block), count + 1
            done.append((*pair, seq, accepted, None if accepted else free, amount, blocked, count))
        if pair is not None:
            self._balances.updateValue(pair, (str(amount), str(blocked), count))
        yield pd.DataFrame(done, columns=CHANGES.fieldNames())

    def close(self) -> None:
        pass


def stateful_changes(commands: DataFrame) -> DataFrame:
    """``CHANGES`` of a stream of wallet commands ``(walletId, assetId, seq, operation, amount, amountRelease)``.

    Commands of a key act in ``seq`` order within a micro-batch, and micro-batches in the order of their arrival. A task
    holds one bucket's commands of one micro-batch, so the trigger's size bounds it.
    """
    spark = commands.sparkSession
    if spark.conf.get(PROVIDER_CONF) != ROCKSDB:
        raise ValueError(f"set {PROVIDER_CONF} to {ROCKSDB}")
    rows = commands.select(
        *KEY,
        "seq",
        F.when(needs_funds(), F.col("amount").cast(LEDGER)).alias("asks"),
        amount_effect().alias("more"),
        blocked_effect().alias("block"),
    )
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).cast("int")
    return rows.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(Balances(), CHANGES, "Append", "None")


def run_stateful_ledger(records: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the changes that the wallet commands of a log make to a parquet folder, each exactly once."""
    spark = records.sparkSession
    before = spark.conf.get(PROVIDER_CONF)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)  # taken over when the query starts
    try:
        good = split_corrupt(decode_events(records.select(*LOG.fieldNames())))[0]
        writer = stateful_changes(deposits(good)).writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", path).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(PROVIDER_CONF, before)


def balances(changes: DataFrame) -> DataFrame:
    """The last balance of each (wallet, asset)."""
    last = changes.groupBy(*KEY).agg(F.max_by(F.struct("amount", "blocked", "txCount"), "seq").alias("last"))
    return last.select(*KEY, "last.*")
