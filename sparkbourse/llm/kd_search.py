"""Exact top-k by integer inner product: a KD-tree in every shard, best box first, the k-th score passed on."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbourse.llm.vectors import best, dealt, equal_together, kth_score, matrix, usable
from sparkbourse.session import stage

SCALE = 256
#: Distinct vectors in a shard, queries that meet a shard in one task, and vectors in a leaf.
SHARD, BLOCK, LEAF = 8192, 8192, 64
FOUND = "query_id long, vec_id long, score long"


class KdTree:
    """Median splits along the widest side; every node keeps the tight box around its points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.children, self.rows, low, high = points, [], [], [], []
        todo = [(np.arange(len(points)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            node, inside = len(self.rows), points[rows]
            low.append(inside.min(axis=0))
            high.append(inside.max(axis=0))
            self.children.append([-1, -1])
            self.rows.append(None)
            if parent >= 0:
                self.children[parent][side] = node
            widths = high[-1] - low[-1]
            if len(rows) <= leaf or not widths.max() > 0:
                self.rows[node] = rows
                continue
            axis, half = int(widths.argmax()), len(rows) // 2
            order = np.argpartition(inside[:, axis], half)
            todo += [(rows[order[:half]], node, 0), (rows[order[half:]], node, 1)]
        self.low, self.high = np.array(low), np.array(high)

    def search(self, query: np.ndarray, k: int, ids: list[list[int]], own: int, least: float = -np.inf) -> list[tuple[float, int]]:
        """The k best ``(score, id)`` at or above ``least``, without the id ``own``; ties to smaller ids.

        A box's bound is the largest inner product of any point in it. Boxes are opened best first, and none whose bound
        lies below the k-th score so far, be it found here or, as ``least``, before.
        """
        bounds = np.maximum(query * self.low, query * self.high).sum(axis=1)
        queue, kept = [(-bounds[0], 0)], []
        while queue and -queue[0][0] >= least:
            node = heapq.heappop(queue)[1]
            if self.rows[node] is None:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            scores = self.points[self.rows[node]] @ query
            for i in np.flatnonzero(scores >= least).tolist():
                kept += [(-scores[i], vec_id) for vec_id in ids[self.rows[node][i]] if vec_id != own]
            if len(kept) >= k:
                kept = heapq.nsmallest(k, kept)
                least = max(least, -kept[-1][0])
        return [(-score, vec_id) for score, vec_id in sorted(kept)[:k]]


def _search_shard(k: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        result = [[], [], []]
        if vectors.num_rows and queries.num_rows:
            width = len(vectors.column("vec")[0])
            points, asked = matrix(vectors.column("vec"), width), matrix(queries.column("vec"), width)
            ids = vectors.column("ids").to_pylist()
            exact = width * np.abs(points).max() * np.abs(asked).max() < 2.0**53
            tree = KdTree(points if exact else points.astype(object))
            for query, query_id, least in zip(asked if exact else asked.astype(object), queries.column("vec_id").to_pylist(), queries.column("least").to_pylist(), strict=True):
                if not exact:
                    query = np.array([int(x) for x in query], object)
                for score, vec_id in tree.search(query, k, ids, query_id, -np.inf if least is None else least):
                    for column, value in zip(result, (query_id, vec_id, max(-(2**63), min(2**63 - 1, int(score)))), strict=True):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in result], ["query_id", "vec_id", "score"])

    return search


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id ``every`` divides, the k best other rows.

    Components become ``floor(scale * x)``; the score is the integer inner product, ties go to smaller ids, and all
    candidates are returned where there are fewer than k. Rows without id, vector, or with a null or non-finite component
    take no part; rows that repeat an id count once. Vectors only meet vectors of the same length. Scores beyond 64 bits
    are the nearest such number. Other columns are not read; an empty table gives no rows.

    Vectors are dealt over shards by hash, equal ones together with their k + 1 smallest ids. First every query searches
    one shard; with the k-th score found there as bound it goes on to all others, in blocks. Both the shards and the
    blocks that meet in a task are bounded.
    """
    whole = F.transform("vec", lambda x: F.floor(x * scale).cast("double"))
    rows = stage(usable(vectors).select("vec_id", whole.alias("vec")), "vectors")
    points = stage(equal_together(rows, k + 1), "points")
    shards = max(1, -(-points.count() // SHARD))
    queries = rows.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // BLOCK))
    queries = queries.select("vec_id", "vec", F.size("vec").alias("width"), dealt(F.col("vec_id"), shards).alias("home"), dealt(F.col("vec_id"), blocks, 1).alias("block"))
    points = points.select("vec", "ids", F.size("vec").alias("width"), dealt(F.col("vec"), shards, 2).alias("shard"))
    points = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(asked: DataFrame) -> DataFrame:
        key = ["width", "shard", "block"]
        return points.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_search_shard(k), FOUND)

    first = stage(meet(queries.withColumn("shard", F.col("home")).withColumn("least", F.lit(None).cast("long"))), "first")
    bounded = queries.join(kth_score(first, k), F.col("vec_id") == F.col("query_id"), "left").drop("query_id")
    others = bounded.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("shard <> home")
    return best(first.union(meet(others)), k)


#: The rows of ``search`` for a table of equally long vectors with unique ids, as DuckDB SQL.
SQL = f"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.vec, v.vec) AS BIGINT) AS score
  FROM usable q JOIN usable v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
