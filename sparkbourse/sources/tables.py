"""Tables over change feeds: the latest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkbourse.functions.wallets import as_map

# Columns the queryable tables show.
ORDER_COLUMNS = (
    "id",
    "baseAssetId",
    "quoteAssetId",
    "walletId",
    "orderType",
    "price",
    "qty",
    "qtyFilled",
    "status",
)


def last_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """Last change of each key, deletions included.

    ``max_by`` keeps one row per key on the map side already, so a key with very many changes costs little.
    """
    rest = [c for c in changes.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("last"))
    return last.select(*keys, "last.*")


def latest_by_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """The table behind a change feed: the last row of each key, unless that is a deletion."""
    return last_changes(changes, keys, order).filter("not is_delete").drop("is_delete")


def snapshot_asof(changes: DataFrame, keys: Sequence[str], seq: int, order: Sequence[str] = ("seq",)) -> DataFrame:
    """The table as it was after change ``seq``."""
    return latest_by_key(changes.filter(F.col("seq") <= seq), keys, order)


def orders(changes: DataFrame) -> DataFrame:
    """The ORDERS table: id and the columns it declares."""
    return latest_by_key(changes, ["id"]).select(*ORDER_COLUMNS)


def wallets(ledger: DataFrame) -> DataFrame:
    """The WALLETS table: assets per wallet, from the ledger rows."""
    return as_map(ledger).select("walletId", "assets")


def materialize(df: DataFrame, path: str, view: str) -> DataFrame:
    """Write a table out as it is now and make it queryable by name."""
    spark: SparkSession = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.createOrReplaceTempView(view)
    return stored
