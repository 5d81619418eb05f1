import numpy as np
import pytest

from sparkbourse.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, whitened string, N int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def plain(vectors, components):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return deviation, centred @ axes / np.sqrt(values), values / np.trace(v)


@pytest.mark.parametrize("rows,width,parts", [(300, 8, 4), (70, 40, 3), (1, 3, 1), (2, 3, 2)])
def test_equal_to_dense_arithmetic(spark, rows, width, parts):
    rng = np.random.default_rng(rows)
    vectors = rng.normal(size=(rows, width)) * np.linspace(0.2, 3, width)
    out = whitening.whiten(frame(spark, vectors).repartition(parts), 5).orderBy("vec_id").collect()
    deviation, whitened, explained = plain(vectors, 5)
    assert [int(r.deviation) for r in out] == deviation and {r.n for r in out} == {rows}
    if rows <= width:  # fewer directions than components vary
        real = [j for j, w in enumerate(out[0].whitened) if w is not None]
        assert len(real) == min(rows - 1, 5)
    else:
        real = list(range(5))
    for j in real:
        mine = np.array([r.whitened[j] for r in out])
        assert min(np.abs(mine - whitened[:, j]).max(), np.abs(mine + whitened[:, j]).max()) < 1e-7
        assert abs(out[0].explained[j] - explained[j]) < 1e-9
    assert (out[0].identity_error is None) == (not real) and all(r.identity_error < 1e-9 for r in out if real)


def test_rows_that_take_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 2], None, [1, None], [nan, 1], [1, inf], [-inf, 1], [], [3, 1], [3, 1], [0, 0], [5], [4, 4]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 7, None, 10, 11]
    out = whitening.by_component(whitening.whiten(frame(spark, vectors, ids))).collect()
    assert sorted((str(r.vec_id), r.component) for r in out) == sorted((str(i), c) for i in (0, 7, 7, None, 11) for c in (1, 2))
    assert {r.n for r in out} == {5}
    deviation, _, _ = plain([[1, 2], [3, 1], [3, 1], [0, 0], [4, 4]], 2)
    assert sorted(r.deviation for r in out if r.component == 1) == sorted(deviation)


def test_no_rows_and_equal_rows(spark):
    assert whitening.by_component(whitening.whiten(frame(spark, []))).count() == 0
    assert whitening.by_component(whitening.whiten(frame(spark, [None, [float("nan")]]))).count() == 0
    out = whitening.whiten(frame(spark, [[1, 2, 3]] * 4)).collect()
    assert all(r.deviation == 0 and r.whitened == [None] * 3 and r.identity_error is None for r in out) and len(out) == 4


def test_planes_give_exact_products():
    rng = np.random.default_rng(0)
    for rows, width, planes in ((1, 1, 1), (64, 3, 5), (65, 4, 9), (200, 5, 20)):
        y = rng.integers(0, 2**planes, size=(rows, width))
        counts = whitening.plane_counts(whitening.bit_planes(y, planes))
        exact = [sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True)) for i in range(width) for j in range(i, width)]
        assert [sum(int(n) << w for w, n in enumerate(row)) for row in counts] == exact


def test_wide_range_stays_exact(spark):
    vectors = [[1e9, 0.0], [-1e9, 0.5], [3.0, 0.25], [1e9, 7.0]]
    out = whitening.whiten(frame(spark, vectors)).orderBy("vec_id").collect()
    assert [int(r.deviation) for r in out] == plain(vectors, 2)[0]
    assert out[0].explained[0] > 0.99


def test_query_over_the_table(spark):
    from sparkbourse.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op12_embedding_whitening"](spark, folder).orderBy("vec_id", "component").collect()
    table = [r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()]
    deviation, whitened, explained = plain(table, 32)
    mine = np.array([r.whitened for r in rows]).reshape(len(table), 32)
    assert [rows[i * 32].deviation for i in range(len(table))] == deviation
    assert np.abs(np.abs(mine) - np.abs(whitened)).max() < 1e-7
    assert max(abs(rows[j].explained / explained[j] - 1) for j in range(32)) < 1e-9 and rows[0].identity_error < 1e-9
