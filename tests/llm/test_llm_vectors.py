"""Both vector searches against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from sparkbourse.llm import kd_search, polytope
from sparkbourse.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score string"
FOLDER = "/root/testdata/sf0.01"


def usable(rows: list[tuple]) -> dict[int, list[float]]:
    found: dict[int, list[float]] = {}
    for vec_id, vec in rows:
        if vec_id is not None and vec and all(x is not None and math.isfinite(x) for x in vec):
            vec = [float(np.float32(x)) for x in vec]
            found[vec_id] = min(found.get(vec_id, vec), vec)
    return found


def exact(rows: list[tuple], k: int, every: int) -> list[tuple]:
    points = {i: [math.floor(256 * x) for x in v] for i, v in usable(rows).items()}
    done = []
    for q in (i for i in points if i % every == 0):
        scores = sorted((-sum(a * b for a, b in zip(points[q], v, strict=True)), i) for i, v in points.items() if i != q and len(v) == len(points[q]))
        done += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(done)


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    rows: list[tuple] = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(200)]  # a third of all are equal
    rows += [(2000, None), (2050, []), (2100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2150, [float("nan")] * 6), (2200, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), (2250, [1.0, 2.0]), (2251, [2.0, 1.0]), (2300, [0.0] * 6), (50, [9.0] * 6), (51, rows[51][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA)


@pytest.mark.parametrize("shard", [40, 8192])
def test_exact_search(spark, monkeypatch, shard):
    monkeypatch.setattr(kd_search, "SHARD", shard)
    monkeypatch.setattr(kd_search, "BLOCK", 5 if shard == 40 else 8192)
    got = sorted(tuple(r) for r in kd_search.search(frame(spark, odd_rows())).collect())
    assert got == exact(odd_rows(), 5, 50)


def test_exact_search_of_huge_components(spark):
    rows = [(i, [1e9 * (i % 7), -1e9 + i]) for i in range(60)]
    assert sorted(tuple(r) for r in kd_search.search(frame(spark, rows)).collect()) == [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in exact(rows, 5, 50)]


def test_tree_opens_few_boxes():
    points = np.floor(256 * np.random.default_rng(1).normal(size=(4000, 3)))
    tree = kd_search.KdTree(points, 16)
    seen = []
    rows = tree.rows
    tree.rows = type("Spy", (list,), {"__getitem__": lambda self, i: (seen.append(i), list.__getitem__(self, i))[1]})(rows)
    query = np.array([700.0, -100.0, 50.0])
    got = tree.search(query, 5, [[i] for i in range(4000)], -1)
    assert [i for _, i in got] == np.lexsort((np.arange(4000), -(points @ query)))[:5].tolist()
    assert len(set(seen)) < len(rows) / 4


def test_empty_tables(spark):
    none = frame(spark, odd_rows()).limit(0)
    assert kd_search.search(none).collect() == [] and polytope.search(none).collect() == []


def test_hadamard_is_a_rotation():
    rows = np.random.default_rng(2).normal(size=(5, 12))
    turned = polytope.rotate(rows, 3)
    assert turned.shape == (5, 16) and np.allclose(rows @ rows.T, turned @ turned.T)


def nearest(rows: list[tuple], k: int, every: int) -> dict[int, list[tuple]]:
    points = {i: np.array(v) for i, v in usable(rows).items() if any(v)}
    return {
        q: sorted((-float((points[q] * v).sum()), i) for i, v in points.items() if i != q and len(v) == len(points[q]))[:k]
        for q in points
        if q % every == 0
    }


def test_approximate_search_of_odd_rows(spark):
    got: dict[int, list] = {}
    for r in polytope.search(frame(spark, odd_rows())).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = nearest(odd_rows(), 20, 20)
    assert set(got) == {q for q, found in want.items() if found}
    points = usable(odd_rows())
    for q, found in got.items():
        assert [r for r, _, _ in sorted(found)] == list(range(1, len(want[q]) + 1))
        assert [(-s, i) for _, i, s in sorted(found)] == sorted((-s, i) for _, i, s in found)
        for _, i, s in found:
            assert s == pytest.approx(float((np.array(points[q]) * np.array(points[i])).sum()), abs=1e-12)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i in found}) for q, found in want.items() if q in got)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    got = {(r.query_id, r.vec_id) for r in QUERIES["op6_nearest_neighbours"](spark, FOLDER).collect()}
    want = {(q, i) for q, found in nearest(rows, 20, 20).items() for _, i in found}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_exact_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op5_exact_top_k"](spark, FOLDER).collect()) == exact(rows, 5, 50)
