"""What both vector searches share: which rows take part, equal vectors, merging of partial results."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec`` (doubles) of rows that take part: with an id and a vector without null or non-finite components.

    Rows that repeat an id count once; if their vectors differ, the smallest does.
    """
    vec = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter("vec_id is not null and size(vec) > 0")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def equal_together(rows: DataFrame, keep: int) -> DataFrame:
    """``vec, ids``: each distinct vector with its ``keep`` smallest ids.

    Ties go to smaller ids, so further ids of one vector are in no result of ``keep - 1`` besides the query's own. Ranks
    are cut before the shuffle, so that a vector held by very many rows stays small.
    """
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).filter(F.col("n") <= keep)
    return ranked.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    return np.asarray(column.combine_chunks().flatten(), dtype=np.float64).reshape(-1, width)


def best(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best by score, ties to smaller ids; each candidate once."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def kth_score(found: DataFrame, k: int) -> DataFrame:
    """``query_id, least``: the k-th best score so far of queries that have k."""
    return best(found, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == k).drop("n")


def dealt(key: Column, parts: int, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(parts)).cast("int")
