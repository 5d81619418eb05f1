import hashlib

import duckdb
import numpy as np
import pytest

from sparkbourse.llm import clustering

SCHEMA = "vec_id long, embedding array<double>, cluster string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "x") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def plain(rows, clusters, rounds):
    """Every distance, one by one."""
    rows = [(i, [int(np.floor(c * 64)) for c in v]) for i, v in rows]
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        owned = [[] for _ in centroids]
        for _, v in rows:
            owned[nearest(v)[1]].append(v)
        centroids = [[sum(d) // len(o) for d in zip(*o, strict=True)] if o else c for o, c in zip(owned, centroids, strict=True)]
    out = [(i, nearest(v)) for i, v in rows]
    sums = [sum(d for _, (d, k) in out if k == c) for c in range(len(centroids))]
    return sorted((i, k, d, sums[k], sum(sums), clustering.digest(centroids[k])) for i, (d, k) in out)


def clustered(df):
    return sorted(tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


@pytest.mark.parametrize("rows,width,clusters,spread", [(400, 6, 16, 1.0), (200, 3, 5, 0.05), (9, 4, 16, 1.0), (300, 64, 16, 0.3)])
def test_equal_to_plain_loops(spark, rows, width, clusters, spread):
    rng = np.random.default_rng(rows)
    vectors = (rng.normal(size=(rows, width)) * spread).tolist()
    vectors[: rows // 4] = [vectors[0]] * (rows // 4)  # ties
    got = clustering.cluster(frame(spark, vectors).repartition(3), clusters, 3, width)
    assert clustered(got) == plain(list(enumerate(vectors)), clusters, 3)


def test_walk_is_exact_and_goes_on_at_equality():
    rng = np.random.default_rng(4)
    for clusters in (1, 2, 7, 16):
        for span in (1, 3, 50):
            centroids, x = rng.integers(-span, span + 1, size=(clusters, 4)), rng.integers(-span - 2, span + 3, size=(300, 4))
            distance = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
            number, best = clustering.Lists(centroids).nearest(x)
            assert (number == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()


def test_rows_that_take_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 2], None, [1, None], [nan, 1], [1, inf], [], [1], [1, 2, 3], [3, 1], [3, 1], [-5, 0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 8, None]
    rows = clustering.cluster(frame(spark, vectors, ids), 2, 3, 2).collect()
    assert sorted(str(r.vec_id) for r in rows) == ["0", "8", "8", "None"]
    assert len({r.cluster for r in rows}) == 2
    assert clustering.cluster(frame(spark, []), 2, 3, 2).count() == 0
    assert clustering.cluster(frame(spark, [None, [1]], None), 2, 3, 2).columns == clustering.cluster(frame(spark, [[1, 2]]), 2, 3, 2).columns


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="a component is beyond"):
        clustering.cluster(frame(spark, [[1e12, 0]]), 2, 1, 2).collect()


def test_equal_to_sql(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = sorted(con.execute(clustering.sql()).fetchall())
    assert clustered(clustering.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))) == want and want
