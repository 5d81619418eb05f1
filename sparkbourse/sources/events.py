"""Event logs: reading and writing ``(key, value, seq)`` records.

A log is a parquet folder, a folder of JSON text, or a Kafka topic. ``seq`` is a record's position and the only order
anything is processed in. Where several logs, topics or partitions are read as one, a position is made of the place in
its source and the number of the source, so that no two records have the same one and none changes when sources are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbourse.operators.lifecycle import command_struct
from sparkbourse.sources.codec import encode_events, envelope
from sparkbourse.functions.orders import stable_id
from sparkbourse.operators.running import running_before

LOG = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)


#: Sources that positions tell apart: logs read together, or topics times the partitions of one.
SOURCES, PARTITIONS = 1 << 16, 1 << 10


def position(place: Column, source: Column | int) -> Column:
    """Position of a record from its place in its source and the source's number; records interleave by place."""
    return (place.cast("long") * SOURCES + source).cast("long")


def place_in_source(seq: Column) -> Column:
    """The place in its own source of a record that ``position`` numbered."""
    return F.shiftright(seq, SOURCES.bit_length() - 1)


def source_number(seq: Column) -> Column:
    """The number of the source of a record that ``position`` numbered."""
    return seq.bitwiseAND(F.lit(SOURCES - 1)).cast("int")


def read_events(
    spark: SparkSession, source: str | Sequence[str], streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """Records of one or several parquet logs, as a batch or as a stream of the files that arrive.

    A single path keeps the ``seq`` of its records. In a list of logs, whose numberings know nothing of each other, each
    record's ``seq`` becomes its ``position``; further logs may be added at the end of the list later on.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if isinstance(source, str):
        return reader.schema(LOG).parquet(source)
    if len(source) > SOURCES:
        raise ValueError(f"more than {SOURCES} logs")
    logs = [reader.schema(LOG).parquet(path).withColumn("seq", position(F.col("seq"), n)) for n, path in enumerate(source)]
    return reduce(DataFrame.unionByName, logs)


def read_json_files(spark: SparkSession, path: str) -> DataFrame:
    """Events from files that hold one JSON document each, ordered by file name."""
    files = spark.read.text(path, wholetext=True).select("value", F.input_file_name().alias("key"))
    numbered = running_before(
        files.withColumn("all", F.lit(0)), ["all"], ["key"], sums={"seq": F.lit(1).cast("long")}, label="files"
    )
    return numbered.select(*LOG.fieldNames())


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str], streaming: bool = True) -> DataFrame:
    """Records of Kafka topics from the beginning; needs the Kafka connector on the class path.

    Offsets only order records within a partition, which is all that keyed processing relies on. Further topics may be
    added at the end of ``topics``, and partitions to a topic, without a change to any position.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    records = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .load()
    )
    return kafka_log(records, topics)


def kafka_log(records: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Log records from ``(topic, partition, offset, key, value)``."""
    if len(topics) > SOURCES // PARTITIONS:
        raise ValueError(f"more than {SOURCES // PARTITIONS} topics")
    number = F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("topic")) - 1
    fits = F.col("partition") < PARTITIONS
    source = F.when(fits, number * PARTITIONS + F.col("partition")).otherwise(F.raise_error(F.lit(f"more than {PARTITIONS} partitions")).cast("long"))
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        position(F.col("offset"), source).alias("seq"),
    )


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Append typed events ``(key, event, seq)`` to a log as JSON."""
    encode_events(events.select("key", "seq", "event")).select(*LOG.fieldNames()).write.mode(mode).parquet(path)


def append_commands(commands: DataFrame, path: str) -> None:
    """Append order commands to a log, each in an event of its own, keyed by order."""
    event_id = stable_id(F.lit("event"), F.col("commandId"))
    events = commands.select(
        F.col("orderId").alias("key"), "seq", envelope(event_id, orderCommand=command_struct()).alias("event")
    )
    write_events(events, path)


def print_log(log: DataFrame) -> DataFrame:
    """The whole log in order, as text."""
    return log.select("seq", "key", "value").orderBy("seq")
