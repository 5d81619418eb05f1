"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SCRATCH_CONF = "spark.sparkbourse.scratchDir"
#: Of the tables this package writes for itself.
COMPRESSION = "zstd"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sparkbourse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for tables that several steps read.

    It is the one named by ``spark.checkpoint.dir`` or, where that is unset, by ``spark.sparkbourse.scratchDir``;
    with neither it lies in the warehouse, which every executor reaches too. Never a machine's own temporary folder.
    """
    for name in (CHECKPOINT_CONF, SCRATCH_CONF):
        folder = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
        if folder:
            return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


#: Tables staged inside the innermost ``temporary`` block.
_HELD: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("held", default=None)


@contextlib.contextmanager
def temporary() -> Iterator[None]:
    """Tables staged inside the block, by whatever operator, are removed at its end."""
    held: list[DataFrame] = []
    token = _HELD.set(held)
    try:
        yield
    finally:
        _HELD.reset(token)
        release(*held)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage so that several readers see the same rows, also after executors are lost. ``release`` removes it, or the
    end of the ``temporary`` block around.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/staged/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=COMPRESSION)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    held = _HELD.get()
    if held is not None:
        held.append(staged)
    return staged


def release(*staged: DataFrame) -> None:
    """Remove tables written by ``stage`` that nothing reads any more."""
    for df in staged:
        path = getattr(df, "_staged_at", None)
        if path:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
