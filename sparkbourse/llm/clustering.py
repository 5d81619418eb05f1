"""Clusters of integer vectors: k-means rounds whose nearest centroid the threshold algorithm finds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbourse.session import stage

WIDTH, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Rows that walk the lists together.
BLOCK = 1024


class Lists:
    """Centroids by dimension, each list sorted by the centroids' value there."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        order = np.argsort(centroids, axis=0, kind="stable")
        self.numbers = order.T.copy()  # width x clusters
        self.values = np.take_along_axis(centroids, order, axis=0).T.copy()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest centroid, ties to the smaller number.

        Each dimension's list is walked outward from the row's value, the nearer side first. Every centroid met anywhere is
        compared in full. What no list has met yet lies at least as far in every dimension as the walk there has come, so
        once the sum of the squared frontier distances exceeds the best distance no other centroid can be as near. At
        equality it could be, with a smaller number: the walk goes on.
        """
        rows, width = x.shape
        clusters = len(self.centroids)
        number, best = np.full(rows, clusters, np.int64), np.full(rows, np.iinfo(np.int64).max, np.int64)
        seen = np.zeros((rows, clusters), bool)
        dim = np.arange(width)[None, :]
        # The first entry not below the value; below and above it is where the walk goes on.
        above = np.stack([np.searchsorted(self.values[d], x[:, d], side="left") for d in range(width)], axis=1)
        below = above - 1
        going = np.arange(rows)
        far = np.iinfo(np.int64).max
        for _ in range(clusters):
            v, up, down = x[going], above[going], below[going]
            to_up = np.where(up < clusters, self.values[dim, np.minimum(up, clusters - 1)] - v, far)
            to_down = np.where(down >= 0, v - self.values[dim, np.maximum(down, 0)], far)
            climbs = to_up <= to_down
            step = np.where(climbs, to_up, to_down)
            met = self.numbers[dim, np.where(climbs, np.minimum(up, clusters - 1), np.maximum(down, 0))]
            above[going], below[going] = up + climbs, down - ~climbs
            fresh = np.zeros((len(going), clusters), bool)
            fresh[np.arange(len(going))[:, None], met] = True
            fresh &= ~seen[going]
            seen[going] |= fresh
            r, c = np.nonzero(fresh)
            distance = ((x[going[r]] - self.centroids[c]) ** 2).sum(axis=1)
            order = np.lexsort((c, distance, r))
            first = np.append(True, r[order][1:] != r[order][:-1]) if len(r) else np.zeros(0, bool)
            row, near, which = going[r[order][first]], distance[order][first], c[order][first]
            closer = (near < best[row]) | ((near == best[row]) & (which < number[row]))
            best[row[closer]], number[row[closer]] = near[closer], which[closer]
            going = going[(step**2).sum(axis=1) <= best[going]]
            if not len(going):
                break
        return number, best


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(start, BLOCK)
            yield batch, np.asarray(batch.column("x").flatten(), np.int64).reshape(-1, width)


def _sums(centroids: np.ndarray):
    """Per task, each cluster's number of rows and their sum by component."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, width = centroids.shape
        lists, total, count = Lists(centroids), np.zeros((clusters, width), np.int64), np.zeros(clusters, np.int64)
        for _, x in _blocks(batches, width):
            number, _ = lists.nearest(x)
            np.add.at(total, number, x)
            count += np.bincount(number, minlength=clusters)
        for c in np.flatnonzero(count):
            columns = [pa.array(np.full(width, c), pa.int32()), pa.array(np.arange(width), pa.int32())]
            yield pa.record_batch([*columns, pa.array(np.full(width, count[c])), pa.array(total[c])], ["cluster", "i", "n", "s"])

    return sums


def _assign(centroids: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for batch, x in _blocks(batches, centroids.shape[1]):
            number, distance = lists.nearest(x)
            yield pa.record_batch([batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return assign


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = 1) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256``: a row for every vector that takes part.

    Of ``vectors(vec_id, embedding)`` those rows take part that have ``width`` components, none of them null or non-finite;
    a component counts as ``floor(scale * c)``. The centroids start as the vectors with the smallest SHA-256 of
    ``seed:vec_id``, in that order; each round moves those that have vectors to the floor of their mean. Repeated rows
    are vectors of their own, also as seeds, where the smaller vector comes first among equal ids; rows without an id come
    last there. With fewer vectors than ``clusters`` all of them are seeds; no rows give no rows; other columns are not
    looked at. Components beyond 2^31 / sqrt(width), whose distances do not fit a long, end the query with an error.

    The rows are written as integers once and read in each round; a round's shuffle and what reaches the driver are sums
    by cluster and component, whatever the number of rows.
    """
    spark = vectors.sparkSession
    e = F.col("e")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    usable = (F.size(e) == width) & F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = int(2**31 / width**0.5) - 1
    whole = F.transform(e, lambda c: F.floor(c * float(scale)).cast("long"))
    fits = F.forall("x", lambda c: F.abs(c) <= most)
    told = F.when(fits, F.col("x")).otherwise(F.raise_error(F.lit(f"a component is beyond {most}")).cast("array<bigint>"))
    x = stage(rows.filter(usable).select("vec_id", whole.alias("x")).select("vec_id", told.alias("x")), "clustering")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    seeds = [r.x for r in x.select("x", hashed.alias("h")).orderBy(F.asc_nulls_last("h"), "x").limit(clusters).collect()]
    if not seeds:
        shape = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<bigint>, centroid_sha256 string"
        return spark.createDataFrame([], shape)
    centroids = np.array(seeds, np.int64)
    for _ in range(rounds):
        parts = x.select("x").mapInArrow(_sums(centroids), "cluster int, i int, n long, s long")
        moved = centroids.copy()
        for r in parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
            moved[r.cluster, r.i] = r.s // r.n
        centroids = moved
    assigned = stage(x.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    at = F.col("cluster") + 1
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))]), at).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*[F.lit([int(v) for v in c]).cast("array<bigint>") for c in centroids]), at).alias("centroid"),
        F.element_at(F.array(*[F.lit(digest(c)) for c in centroids]), at).alias("centroid_sha256"),
    )


def sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = 1) -> str:
    """The same as DuckDB SQL: every distance is computed, by component."""
    parts = [
        f"""kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {scale}) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        f"""seeds AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS cluster, x FROM kept)""",
        f"""c0 AS (SELECT cluster, x FROM seeds WHERE cluster < {clusters})""",
    ]
    for k in range(rounds + 1):
        distance = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        parts.append(
            f"""a{k} AS (SELECT r, vec_id, x, cluster, d FROM
  (SELECT v.r, v.vec_id, v.x, c.cluster, CAST({distance} AS BIGINT) AS d FROM kept v, c{k} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1)"""
        )
        if k < rounds:
            mean = "CAST(sum(v) // count(*) AS BIGINT) - CASE WHEN sum(v) < 0 AND sum(v) % count(*) <> 0 THEN 1 ELSE 0 END"
            parts.append(
                f"""m{k} AS (SELECT cluster, list(m ORDER BY i) AS x FROM (SELECT cluster, i, {mean} AS m
  FROM (SELECT cluster, unnest(x) AS v, unnest(range({width})) AS i FROM a{k}) GROUP BY cluster, i) GROUP BY cluster)"""
            )
            parts.append(f"c{k + 1} AS (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m USING (cluster))")
    last = f"a{rounds}"
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM {last} a JOIN c{rounds} c USING (cluster)"""
    )
