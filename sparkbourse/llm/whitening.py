"""Whitening of embeddings: exact scatter from bit planes, principal components, projection."""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.session import stage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: A component with less than this share of all variance has none but rounding; nothing is divided by it.
NO_VARIANCE = 1e-13
#: Rows whose planes are counted at a time, a multiple of 64.
BLOCK = 1 << 14


def integers(vec: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Components as integers: ``floor(scale * c) + shift``."""
    return F.transform(vec.cast("array<double>"), lambda c: F.floor(c * float(scale)).cast("long") + F.lit(shift).cast("long"))


def finite(vec: Column) -> Column:
    """Whether a vector is there and so are all its components, as finite numbers."""
    return vec.isNotNull() & F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.asarray(batch.column("x").flatten(), np.int64).reshape(-1, width)


def bit_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """Planes of non-negative integers, rows x width, as width x planes x words: 64 rows to a word, the missing ones zero."""
    rows, width = values.shape
    padded = np.zeros((-(-rows // 64) * 64, width), np.int64)
    padded[:rows] = values
    packed = [np.packbits((padded.T >> a & 1).astype(np.uint8), axis=1, bitorder="little") for a in range(planes)]
    return np.ascontiguousarray(np.stack(packed, axis=1)).view(np.uint64)


def plane_counts(planes: np.ndarray) -> np.ndarray:
    """For each pair of dimensions i <= j and each weight w the rows, counted over all planes a + b = w, in which plane a of
    i and plane b of j are both set; a pair's sum of products is then the sum of ``2^w`` times the counts."""
    width, depth, words = planes.shape
    left, right = np.triu_indices(width)
    counts = np.zeros((len(left), 2 * depth - 1), np.int64)
    flat = planes.reshape(width * depth, words)
    for i in range(width):
        rest = flat[i * depth :]  # planes of dimension i and all later ones
        mine = np.flatnonzero(left == i)
        for a in range(depth):
            both = np.bitwise_count(rest & flat[i * depth + a]).sum(axis=1, dtype=np.int64).reshape(-1, depth)
            counts[mine, a : a + depth] += both
    return counts


def _scatter(least: list[int], planes: int):
    """Per task, sums of products of all pairs of dimensions, shifted by the least value of each."""
    width = len(least)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, rows = 0, [], 0

        def packed() -> np.ndarray:
            return plane_counts(bit_planes(np.concatenate(held) - np.array(least), planes))

        for batch in batches:
            held.append(_rows(batch, width))
            rows += batch.num_rows
            if rows >= BLOCK:
                counts, held, rows = counts + packed(), [], 0
        if rows:
            counts = counts + packed()
        if isinstance(counts, np.ndarray):
            left, right = np.triu_indices(width)
            sums = [decimal.Decimal(sum(int(n) << w for w, n in enumerate(row))) for row in counts]
            yield pa.record_batch([pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(sums, pa.decimal128(38, 0))], ["i", "j", "s"])

    return scatter


def covariance(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix from exact sums: centred as integers, ``n * sum(xy) - sum(x) * sum(y)``, and divided last."""
    v = np.zeros((len(sums), len(sums)))
    for (i, j), s in products.items():
        v[i, j] = v[j, i] = float(Fraction(n * s - sums[i] * sums[j], n * n))
    return v


def principal(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and their unit eigenvectors as columns, each with its largest entry positive."""
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    peak = np.abs(vectors).argmax(axis=0)
    return values[order], vectors * np.sign(vectors[peak, np.arange(vectors.shape[1])])


def _project(n: int, sums: list[int], least: list[int], planes: int, axes: np.ndarray, roots: np.ndarray):
    """``deviation`` and ``w``, the whitened values, of each row; components without variance are null."""
    width, low = len(sums), np.array(least, np.int64)
    shifted = [s - n * lo for s, lo in zip(sums, least, strict=True)]
    mean = np.array([s / n for s in shifted])
    fits = (n << planes) ** 2 * width < 2**63  # else in whole numbers of any size
    total = np.array(shifted, np.int64 if fits else object)
    safe = np.where(roots > 0, roots, 1.0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _rows(batch, width) - low
            squares = (((y if fits else y.astype(object)) * n - total) ** 2).sum(axis=1)
            deviation = pa.array(squares).cast(pa.decimal128(38, 0)) if fits else pa.array([decimal.Decimal(int(d)) for d in squares], pa.decimal128(38, 0))
            whitened = (y - mean) @ axes / safe
            flat = pa.array(whitened.ravel(), pa.float64(), mask=np.tile(roots <= 0, len(y)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * len(roots), pa.int32()), flat)
            yield pa.record_batch([batch.column("vec_id"), deviation, lists], ["vec_id", "deviation", "w"])

    return project


def _moments(usable: int):
    """Per task, the number of rows, and sums of the whitened values and of their products."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, n = np.zeros((usable, usable)), np.zeros(usable), 0
        for batch in batches:
            w = np.asarray(batch.column("w").flatten(), np.float64).reshape(batch.num_rows, -1)[:, :usable]
            products, sums, n = products + w.T @ w, sums + w.sum(axis=0), n + len(w)
        if n:
            i, j = np.triu_indices(usable)
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(products[i, j]), pa.array(np.where(i == j, sums[i], 0.0))]
            yield pa.record_batch(columns, ["i", "j", "p", "s"])

    return moments


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, n, deviation, whitened, eigenvalues, explained, identity_error``: a row for every usable row of
    ``vectors(vec_id, embedding)``; ``whitened``, ``eigenvalues`` and ``explained`` are arrays over the components.

    Rows take part whose vector is there and holds neither null nor non-finite entries, all of them, also for the fit;
    repeated rows count as often as they occur, null ids are passed on, other columns are not looked at. Vectors of another
    width than the most frequent one (of equally frequent ones the largest) have no place in the same matrix and take no
    part. Entries of a component without variance are null; all are if there is a single vector. No rows give no rows.
    ``deviation`` has room for 38 digits, more than that ends the query with an error.

    A fit reads the rows twice: once for width, least, largest value and sum of each dimension, and once for the scatter,
    which each task counts from bit planes and Spark adds up. What reaches the driver grows with the square of the width,
    never with the rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    x = stage(rows.filter(finite(F.col("e")) & (F.size("e") > 0)).select("vec_id", integers(F.col("e")).alias("x")), "whitening")
    widths = x.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    shape = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, eigenvalues array<double>, explained array<double>, identity_error double"
    if widths is None:
        return spark.createDataFrame([], shape)
    width, n = int(widths[0]), int(widths[1])
    x = x.filter(F.size("x") == width)
    by_dimension = x.select(F.posexplode("x").alias("i", "v")).groupBy("i")
    dims = by_dimension.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    least, sums = [r.lo for r in dims], [int(r.s) for r in dims]
    planes = max(1, max(r.hi - r.lo for r in dims).bit_length())
    pairs = x.select("x").mapInArrow(_scatter(least, planes), "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
    products = {(r.i, r.j): int(r.s) for r in pairs.collect()}
    shifted = [s - n * lo for s, lo in zip(sums, least, strict=True)]  # covariances do not change with a shift
    v = covariance(n, shifted, products)
    values, axes = principal(v, components)
    trace = float(np.trace(v))
    real = values > NO_VARIANCE * trace if trace > 0 else np.zeros(len(values), bool)
    roots = np.where(real, np.sqrt(np.where(real, values, 0.0)), 0.0)
    projected = stage(x.mapInArrow(_project(n, sums, least, planes, axes, roots), "vec_id long, deviation decimal(38,0), w array<double>"), "whitened")
    error, usable = None, int(real.sum())
    if usable:
        parts = projected.select("w").mapInArrow(_moments(usable), "i int, j int, p double, s double").groupBy("i", "j").agg(F.sum("p").alias("p"), F.sum("s").alias("s")).collect()
        mean = {r.i: r.s / n for r in parts if r.i == r.j}
        error = max(abs(r.p / n - mean[r.i] * mean[r.j] - (r.i == r.j)) for r in parts)
    doubles = lambda c: F.lit(c).cast("double")
    return projected.select(
        "vec_id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.col("w").alias("whitened"),
        F.array(*[doubles(float(e)) for e in values]).alias("eigenvalues"),
        F.array(*[doubles(float(e) / trace if trace > 0 else None) for e in values]).alias("explained"),
        doubles(error).alias("identity_error"),
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for every vector and component.

    Here ``deviation`` is a long; where one is too large for that the query ends with an error."""
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("p", "c")
    rows = whitened.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", each)
    component = (F.col("p") + 1).cast("int").alias("component")
    return rows.select("vec_id", component, "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
