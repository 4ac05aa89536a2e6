"""Whitening of embeddings along their leading principal components.

The covariance is summed on the executors from centred vectors.  The driver, which gets
only its d x d entries, reduces it to a tridiagonal matrix by Householder reflections,
finds the leading eigenvalues by bisection on Sturm counts and their vectors by inverse
iteration, where vectors of close eigenvalues are made orthogonal again after each
step.  The components are then broadcast and every vector is projected once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import row_slices, share, shared

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# The driver holds d x d doubles; longer vectors are refused.
MOST_DIMENSIONS = 2048
# Entries from here on have no exact place as a long and count as non-finite.
_LARGEST = float(1 << 53)
_SAFE = 1 << 62
_EPS = np.finfo(float).eps
# Eigenvalues closer than this part of the matrix's norm have their vectors made orthogonal.
_CLOSE = 1e-3
_STEPS = 6

_RESULT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


# -- eigenvectors of a symmetric matrix ----------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the reflections that lead to them."""
    a, reflections = matrix.copy(), []
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if not length or not np.any(x[1:]):
            continue
        x[0] += np.copysign(length, x[0])
        v = x / np.linalg.norm(x)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_count(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """Eigenvalues below each of ``at``: negative pivots of the shifted matrix."""
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(int)
    for d, square in zip(diagonal[1:], squares, strict=True):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - at - square / pivot
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection down to neighbouring doubles."""
    around = np.zeros(len(diagonal))
    around[:-1] += np.abs(off)
    around[1:] += np.abs(off)
    norm = float(np.max(np.abs(diagonal) + around))
    squares, least = off * off, max(norm * norm, 1.0) * np.finfo(float).tiny / _EPS
    rank = len(diagonal) - 1 - np.arange(count)
    low = np.full(count, float(np.min(diagonal - around)) - norm * _EPS)
    high = np.full(count, float(np.max(diagonal + around)) + norm * _EPS)
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        above = sturm_count(diagonal, squares, middle, least) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _shifted_solve(diagonal: np.ndarray, off: np.ndarray, shift: float, least: float):
    """A solver of (T - shift) x = b by elimination with row exchanges."""
    n = len(diagonal)
    main, upper, second = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    factors, swaps = np.zeros(n), np.zeros(n, bool)
    for k in range(n - 1):
        if abs(main[k]) < abs(off[k]):
            swaps[k] = True
            factor = main[k] / off[k]
            main[k], old = off[k], upper[k]
            upper[k], main[k + 1] = main[k + 1], old - factor * main[k + 1]
            second[k], upper[k + 1] = upper[k + 1], -factor * upper[k + 1]
        else:
            factor = off[k] / main[k] if main[k] else 0.0
            main[k + 1] -= factor * upper[k]
        factors[k] = factor
    main = np.where(np.abs(main) < least, least, main)

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for k in range(n - 1):
            if swaps[k]:
                x[k], x[k + 1] = x[k + 1], x[k]
            x[k + 1] -= factors[k] * x[k]
        for k in range(n - 1, -1, -1):
            if k + 1 < n:
                x[k] -= upper[k] * x[k + 1]
            if k + 2 < n:
                x[k] -= second[k] * x[k + 2]
            x[k] /= main[k]
        return x

    return solve


def _without(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            x = x - (other @ x) * other
    return x


def leading_components(matrix: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of a symmetric matrix and their unit eigenvectors, as rows."""
    diagonal, off, reflections = tridiagonal(matrix)
    n = len(diagonal)
    norm = float(np.max(np.abs(diagonal)) + (2 * np.max(np.abs(off)) if n > 1 else 0.0)) or 1.0
    values = leading_eigenvalues(diagonal, off, min(count, n))
    vectors: list[np.ndarray] = []
    random = np.random.default_rng(0)
    for k, value in enumerate(values):
        first = k
        while first and values[first - 1] - values[first] <= _CLOSE * norm:
            first -= 1
        close = vectors[first:k]
        # Equal eigenvalues get slightly different shifts.
        solve = _shifted_solve(diagonal, off, value - (k - first) * 2 * _EPS * norm, _EPS * norm)
        x = _without(random.standard_normal(n), close)
        for _ in range(_STEPS):
            x = _without(solve(x / np.linalg.norm(x)), close)
        vectors.append(x / np.linalg.norm(x))
    found = np.array(vectors)
    for start, v in reversed(reflections):
        found[:, start:] -= 2 * np.outer(found[:, start:] @ v, v)
    return values, found


# -- sums over all vectors ------------------------------------------------------------


def _as_integers(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """Rows of x = floor(SCALE * c) + SHIFT."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * values).astype(np.int64) + SHIFT).reshape(batch.num_rows, -1)


def _exact_sum(x: np.ndarray, axis: int) -> np.ndarray:
    largest = int(np.abs(x).max(initial=0)) if x.dtype != object else _SAFE
    return (x if largest * x.shape[axis] < _SAFE else x.astype(object)).sum(axis=axis)


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as long integers, or Python's where those are too small."""
    fits = n * (int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) // n + 1) < _SAFE
    return n * x - np.array(sums, np.int64) if fits else n * x.astype(object) - np.array(sums, object)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = 0, 0
    for whole in batches:
        for batch in row_slices(whole, column=0):
            total = total + _exact_sum(_as_integers(batch, 0), 0).astype(object)
            n += batch.num_rows
    if n:
        fields = [pa.array([n], pa.int64()), pa.array([[str(s) for s in total]], pa.list_(pa.string()))]
        yield pa.record_batch(fields, names=["n", "s"])


@dataclass(frozen=True)
class Whitener:
    """Count and sums of all vectors, components, and the factor that makes variances one."""

    n: int
    sums: list[int]
    components: np.ndarray
    explained: np.ndarray
    scales: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _differences(x, self.n, self.sums).astype(float) / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.components.T) * self.scales


def _moments(model, centre):
    """A task's sums of products of centred vectors, upper half: ``i, j, v``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (whitener,), total = shared(model), None
        for whole in batches:
            for batch in row_slices(whole, column=0):
                y = centre(whitener, _as_integers(batch, 0))
                products = y.T @ y
                total = products if total is None else total + products
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.record_batch(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"]
            )

    return run


def _covariance(vectors: DataFrame, whitener: Whitener, centre, size: int) -> np.ndarray:
    """Gathers size * (size + 1) / 2 sums, whatever the number of rows."""
    model = share(vectors.sparkSession, whitener)
    sums = vectors.mapInArrow(_moments(model, centre), "i int, j int, v double")
    found = sums.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    matrix = np.zeros((size, size))
    i, j = (found[c].to_numpy() for c in "ij")
    matrix[i, j] = matrix[j, i] = found["v"].to_numpy()
    return matrix / whitener.n


def usable(rows: DataFrame, id_column: str = "vec_id", vector_name: str = "embedding") -> DataFrame:
    """``id, c`` of the rows whose vector is not null and holds only finite, non-null numbers."""
    vector = F.col(vector_name).cast("array<double>")
    finite = F.forall("c", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < _LARGEST))
    return rows.select(F.col(id_column).alias("id"), vector.alias("c")).where(F.col("c").isNotNull() & finite)


def fit(vectors: DataFrame, count: int = COMPONENTS) -> tuple[Whitener, int] | None:
    """The whitener of ``c`` vectors and their dimension; None where nothing varies."""
    lengths = vectors.groupBy(F.size("c").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d"))
    first = lengths.first()
    if first is None or not first.d:
        return None
    d = first.d
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions; the limit is {MOST_DIMENSIONS}")
    same = vectors.where(F.size("c") == d)
    parts = same.select("c").mapInArrow(_sums, "n long, s array<string>")
    entries = parts.select("n", F.posexplode("s").alias("j", "s"))
    sums = (
        entries.groupBy("j")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        .orderBy("j")
        .collect()
    )
    n, totals = sums[0].n, [int(r.s) for r in sums]
    nothing = np.zeros(0)
    plain = Whitener(n, totals, np.eye(d), nothing, np.ones(d))
    covariance = _covariance(same.select("c"), plain, Whitener.centred, d)
    trace = float(np.trace(covariance))
    if not trace:
        return None
    values, components = leading_components(covariance, count)
    real = values > trace * d * 8 * _EPS
    return Whitener(n, totals, components[real], values[real] / trace, 1 / np.sqrt(values[real])), d


def identity_error(vectors: DataFrame, whitener: Whitener) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    size = len(whitener.scales)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (w,), total = shared(model), np.zeros(size)
        for whole in batches:
            for batch in row_slices(whole, column=0):
                total += w.project(_as_integers(batch, 0)).sum(axis=0)
        yield pa.record_batch([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["j", "v"])

    model = share(vectors.sparkSession, whitener)
    summed = vectors.mapInArrow(means, "j int, v double").groupBy("j").agg(F.sum("v").alias("v")).orderBy("j").collect()
    mean = np.array([r.v for r in summed]) / whitener.n
    covariance = _covariance(vectors, whitener, lambda w, x: w.project(x) - mean, size)
    return float(np.abs(covariance - np.eye(size)).max())


def whiten(
    rows: DataFrame, count: int = COMPONENTS, id_column: str = "vec_id", vector_name: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

    Rows whose vector is null or holds null or non-finite entries are left out, as are
    entries of 2^53 / SCALE and more.  Where lengths differ, the commonest (of equally common ones the
    longest) is taken and the others are left out.  Directions without variance have no
    component: a vector of fewer dimensions, or a table of equal vectors, an empty one or
    a single row gives fewer rows, or none.  Repeated rows and ids, and a null id, are rows like
    any other and all count.  ``deviation`` is null where it exceeds a long.  Other columns are not read.

    The table is read five times, its vectors only; nothing but sums is shuffled.  The
    driver gets d * (d + 1) / 2 sums, so the dimension is bounded and the rows are not.
    """
    spark = rows.sparkSession
    vectors = usable(rows, id_column, vector_name)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = _RESULT.format(id=kind)
    found = fit(vectors, count)
    if found is None:
        return spark.createDataFrame([], schema)
    whitener, d = found
    same = vectors.where(F.size("c") == d)
    error = identity_error(same.select("c"), whitener)
    model = share(spark, whitener)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (w,) = shared(model)
        size = len(w.scales)
        for whole in batches:
            for batch in row_slices(whole):
                x = _as_integers(batch, 1)
                far = _differences(x, w.n, w.sums)
                square = int(np.abs(far).max(initial=0)) ** 2 * x.shape[1]
                far = far if square < _SAFE else far.astype(object)
                deviations = [s if s < 1 << 63 else None for s in map(int, (far * far).sum(axis=1))]
                n = batch.num_rows
                each = np.repeat(np.arange(n), size)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * size, w.n)),
                        pa.array(deviations, pa.int64()).take(pa.array(each)),
                        pa.array(w.project(x).ravel()),
                        pa.array(np.tile(w.explained, n)),
                        pa.array(np.full(n * size, error)),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return same.mapInArrow(run, schema)
