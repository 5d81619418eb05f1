"""What the operators share: reading tables, batches for Arrow functions, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most so many rows, so that a batch of long ones fits in memory."""
    if int(spark.conf.get(BATCH_CONF)) > rows:
        spark.conf.set(BATCH_CONF, str(rows))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front as long as ``df`` has such a column (letter case does not count)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
