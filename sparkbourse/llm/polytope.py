"""Approximate nearest neighbours: cross-polytope hashing with many probes, exact scores for all candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbourse.llm.vectors import best, dealt, equal_together, kth_score, matrix, usable
from sparkbourse.session import stage

#: Hash tables, and buckets that a query visits in each.
TABLES, PROBES = 12, 10
#: Vectors and queries that meet in one task, about.
SHARD, BLOCK = 8192, 8192
FOUND = "query_id long, vec_id long, score double"


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    width, half = rows.shape[1], 1
    while half < width:
        pairs = rows.reshape(len(rows), -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), width)
        half *= 2
    return rows / np.sqrt(width)


def rotate(rows: np.ndarray, table: int) -> np.ndarray:
    """A pseudo-random rotation: three times random signs and a Hadamard transform, after padding to a power of two."""
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    signs = np.random.default_rng(1000 + table)
    for _ in range(3):
        rows = hadamard(rows * signs.choice([-1.0, 1.0], width))
    return rows


def nearest_axes(rows: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The ``probes`` signed axes nearest to each rotated vector, nearest first: axis a is 2a, its opposite 2a + 1."""
    turned = rotate(rows, table)
    along = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
    return np.argsort(-along, axis=1, kind="stable")[:, :probes]


def _hash(tables: int, probes: int):
    """Adds ``table``, ``bucket`` and ``probe`` for every table and probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.asarray(batch.column("width"))
            for width in np.unique(widths):
                some = batch.filter(pa.array(widths == width))
                rows = matrix(pa.chunked_array([some.column("vec")]), int(width))
                length = np.linalg.norm(rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300), axis=1, keepdims=True)
                unit = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300) / length
                for table in range(tables):
                    axes = nearest_axes(unit, table, probes)
                    copies = axes.shape[1]
                    wide = some.take(pa.array(np.repeat(np.arange(len(rows)), copies)))
                    extra = [np.full(axes.size, table, np.int32), axes.reshape(-1).astype(np.int32), np.tile(np.arange(copies, dtype=np.int32), len(rows))]
                    yield pa.record_batch([*wide.columns, *map(pa.array, extra)], [*wide.schema.names, "table", "bucket", "probe"])

    return run


def _rerank(k: int):
    def rerank(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        parts = []
        if vectors.num_rows and queries.num_rows:
            width = len(vectors.column("vec")[0])
            points, asked = matrix(vectors.column("vec"), width), matrix(queries.column("vec"), width)
            ids = vectors.column("ids").to_pylist()
            least = queries.column("least").to_pandas().fillna(-np.inf).to_numpy()
            own = queries.column("vec_id").to_pylist()
            for at in range(0, len(asked), 512):
                block = asked[at : at + 512] @ points.T
                for i, scores in enumerate(block, at):
                    floor = least[i]
                    if len(scores) > k + 1:
                        floor = max(floor, np.partition(scores, -k - 1)[-k - 1])
                    near = np.flatnonzero(scores >= floor - 1e-9 * max(1.0, abs(floor) if np.isfinite(floor) else 1.0))
                    exact = (points[near] * asked[i]).sum(axis=1).tolist()  # the same sum wherever a vector stands
                    parts += [(own[i], vec_id, score) for n, score in zip(near.tolist(), exact, strict=True) for vec_id in ids[n] if vec_id != own[i]]
        frame = pd.DataFrame(parts, columns=["query_id", "vec_id", "score"])
        frame = frame.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k)
        return pa.Table.from_pandas(frame, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]), preserve_index=False)

    return rerank


def search(vectors: DataFrame, k: int = 20, every: int = 20, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id ``every`` divides, the k nearest other rows found.

    Nearest means largest inner product, in double precision on the original vectors; ties go to smaller ids. Vectors are
    hashed by direction, so vectors of equal length are found best. Rows without id or vector, with a null or non-finite
    component or with zeros only take no part; rows that repeat an id count once; vectors only meet vectors of the same
    width. Where a query finds fewer than k in its buckets, it is held against all rows, so it gets all there are. An
    empty table gives no rows.

    Every vector is in one bucket of each table, the signed axis nearest to it after a pseudo-random rotation; a query
    visits the ``probes`` nearest. Large buckets are dealt over several tasks. The nearest bucket of each table comes
    first and gives a bound below which the others report nothing. Equal vectors go together with their k + 1 smallest
    ids.
    """
    rows = stage(usable(vectors).filter(F.exists("vec", lambda x: x != 0)), "vectors")
    points = stage(equal_together(rows, k + 1).withColumn("width", F.size("vec")), "points")
    queries = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "vec", F.size("vec").alias("width"))
    n, asked_n = points.count(), queries.count()
    # About the share of one bucket in twice as many buckets as dimensions, with room for crowded ones.
    width = points.agg(F.min("width")).first()[0] or 1
    salts, blocks = max(1, -(-4 * n // (2 * width * SHARD))), max(1, -(-4 * asked_n * probes // (2 * width * BLOCK)))
    key = ["width", "table", "bucket", "salt", "block"]
    index = points.mapInArrow(_hash(tables, 1), "vec array<double>, ids array<long>, width int, table int, bucket int, probe int")
    index = index.withColumn("salt", dealt(F.col("vec"), salts)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    probed = queries.mapInArrow(_hash(tables, probes), "vec_id long, vec array<double>, width int, table int, bucket int, probe int")
    probed = probed.withColumn("block", dealt(F.col("vec_id"), blocks, 1))

    def meet(asked: DataFrame) -> DataFrame:
        spread = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return index.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(_rerank(k), FOUND)

    first = stage(meet(probed.filter("probe = 0").withColumn("least", F.lit(None).cast("double"))), "first")
    bounded = probed.filter("probe > 0").join(kth_score(first, k), F.col("vec_id") == F.col("query_id"), "left").drop("query_id")
    found = stage(best(first.union(meet(bounded)), k), "found")
    # The exact way for queries whose buckets hold too few: all rows, in blocks.
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= min(k, max(0, n - 1)))
    short = queries.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti").withColumn("least", F.lit(None).cast("double"))
    parts = max(1, -(-n // SHARD))
    short = short.withColumn("block", dealt(F.col("vec_id"), blocks, 1)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    everything = points.withColumn("salt", dealt(F.col("vec"), parts, 2)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rest = everything.groupBy("width", "salt", "block").cogroup(short.groupBy("width", "salt", "block")).applyInArrow(_rerank(k), FOUND)
    done = found.join(enough.select("query_id"), "query_id", "left_semi")
    return done.select("query_id", "rank", "vec_id", "score").unionByName(best(rest, k))
