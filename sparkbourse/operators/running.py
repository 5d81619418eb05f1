"""Running aggregates that do not put a whole key into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key through one task. That is right while the largest key
is small, which is checked by counting first. Beyond that the rows are range partitioned on ``(keys, order)`` so that
a hot key spans many chunks, each chunk is aggregated on its own, and the totals of the chunks before it are added.
A chunk holds at most one key that started in an earlier chunk, so the table of carried totals has fewer rows than
there are chunks, whatever the data: it is safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbourse.session import stage

CHUNK = "_chunk"
MAX_GROUP_CONF = "spark.sparkbourse.maxGroupRows"
MAX_GROUP_ROWS = 1_000_000


def max_group_rows(df: DataFrame) -> int:
    """Most rows of one key that may be handled by a single task."""
    return int(df.sparkSession.conf.get(MAX_GROUP_CONF, str(MAX_GROUP_ROWS)))


#: Parts into which keys are dealt to see whether any can be hot.
_DEALT = 4096


def has_hot_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """True if some key has more rows than one task should get; counted with map-side combine.

    A key has no more rows than the part its hash falls into. Few parts are counted first; only if one of them is too
    large are keys counted, which shuffles a row for each.
    """
    limit = max_group_rows(df)
    for by in ([F.pmod(F.xxhash64(*keys), F.lit(_DEALT))], keys):
        largest = df.groupBy(*by).count().agg(F.max("count")).first()[0]
        if (largest or 0) <= limit:
            return False
    return True


def _sum_type(value: T.DataType) -> T.DataType:
    """Type of a running sum; one digit short of the widest decimal so that adding two keeps the scale."""
    if isinstance(value, T.DecimalType):
        return T.DecimalType(min(value.precision + 10, 37), value.scale)
    return T.DoubleType() if isinstance(value, (T.DoubleType, T.FloatType)) else T.LongType()


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    hot: bool | None = None,
    label: str = "running",
) -> DataFrame:
    """Add, per row, aggregates over the earlier rows of the same key (the row itself excluded).

    ``sums`` maps an output column to a summed expression (0 where there are no earlier rows), ``maxima`` to an
    expression whose largest earlier value is wanted (NULL where there are none). ``keys`` must not be NULL; rows
    that tie on ``order`` must not depend on each other's values. ``hot`` passes on what the caller already knows
    about the size of the largest key.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    hot = has_hot_key(df, keys) if hot is None else hot
    value_names = {name: f"_v_{name}" for name in (*sums, *maxima)}
    valued = df.withColumns({value_names[name]: value for name, value in (sums | maxima).items()})
    sum_types = {name: _sum_type(valued.schema[value_names[name]].dataType) for name in sums}

    def or_zero(column: str, dtype: T.DataType) -> Column:
        return F.coalesce(F.col(column).cast(dtype), F.lit(0).cast(dtype))

    def running(rows: DataFrame, group: Sequence[str]) -> DataFrame:
        earlier = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns(
            {name: F.sum(value_names[name]).over(earlier) for name in sums}
            | {name: F.max(value_names[name]).over(earlier) for name in maxima}
        )

    if not hot:
        return running(valued, keys).select(
            *df.columns, *[or_zero(name, dtype).alias(name) for name, dtype in sum_types.items()], *maxima
        )

    # Adaptive execution merges only neighbouring ranges, so the partition number still follows the order.
    chunked = stage(valued.repartitionByRange(*keys, *order).withColumn(CHUNK, F.spark_partition_id()), label)
    group = [*keys, CHUNK]
    earlier_chunks = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        chunked.groupBy(*group)
        .agg(
            *[F.sum(value_names[name]).alias(f"_t_{name}") for name in sums],
            *[F.max(value_names[name]).alias(f"_t_{name}") for name in maxima],
        )
        .withColumns(
            {"_earlier": F.count(F.lit(1)).over(earlier_chunks)}
            | {f"_c_{name}": F.sum(f"_t_{name}").over(earlier_chunks) for name in sums}
            | {f"_c_{name}": F.max(f"_t_{name}").over(earlier_chunks) for name in maxima}
        )
        .filter("_earlier > 0")
        .select(*group, *[f"_c_{name}" for name in (*sums, *maxima)])
    )
    combined = {
        name: (or_zero(name, dtype) + or_zero(f"_c_{name}", dtype)).cast(dtype) for name, dtype in sum_types.items()
    } | {name: F.greatest(F.col(name), F.col(f"_c_{name}")) for name in maxima}
    return (
        running(chunked, group)
        .join(F.broadcast(carried), group, "left")
        .select(*df.columns, *[value.alias(name) for name, value in combined.items()])
    )


def spread_join(
    many: DataFrame, few: DataFrame, keys: Sequence[str], spread_by: str, how: str = "inner", label: str = "spread"
) -> DataFrame:
    """Equi-join in which a key may have very many rows in ``many`` but only a bounded number in ``few``.

    Rows of a hot key are dealt to several tasks by a hash of ``spread_by``; the few rows of the other side go to each
    of them. There are at most (all rows / limit) hot keys, and in total that many copies of a key's few rows.
    """
    limit = max_group_rows(many)
    many = stage(many, label)
    hot = (
        many.groupBy(*keys)
        .count()
        .filter(F.col("count") > limit)
        .select(*keys, F.ceil(F.col("count") / limit).cast("int").alias("_tasks"))
    )
    tasks = F.coalesce(F.col("_tasks"), F.lit(1))
    dealt = many.join(F.broadcast(hot), [*keys], "left").withColumn("_task", F.pmod(F.xxhash64(spread_by), tasks).cast("int"))
    copied = few.join(F.broadcast(hot), [*keys], "left").withColumn("_task", F.explode(F.sequence(F.lit(0), tasks - 1)))
    return dealt.drop("_tasks").join(copied.drop("_tasks"), [*keys, "_task"], how).drop("_task")
