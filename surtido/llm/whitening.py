"""Whitening of vectors by the leading components of their covariance.

Spark adds up the distinct vectors and their centred products; the covariance, whose size is
the dimension's square whatever the rows, is solved on the driver by contour integration
(FEAST; Polizzi, 2009): the quadrature of complex shifted solves around an interval filters
a block of vectors down to the eigenvectors inside, Rayleigh-Ritz extracts them, and counts of
the eigenvalues below the interval's ends, by inertia, tell that none is missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.llm.common import by_value, stored

by_value(__name__)

COMPONENTS = 16
# Whole steps per unit of an entry, and what is added to them.
SCALE = 64
SHIFT = 1_000_000
# Entries beyond this many steps would pass the 64-bit sums of a batch.
LARGEST = 1 << 40
# Eigenvalues in an interval, at most, unless they are equal to rounding.
INTERVAL_MOST = 6
# Vectors filtered beyond the eigenvalues of an interval, points of the half contour, and
# filtering rounds at most.
SPARE = 6
POINTS = 8
FILTER_ROUNDS = 40

_EPS = np.finfo(np.float64).eps


# --- Eigenvalues of the covariance --------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal) of a symmetric matrix after Householder reflections."""
    a = matrix.copy()
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v /= size
        a[k + 1:] -= 2 * np.outer(v, v @ a[k + 1:])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_below(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues below the shift: negative pivots of the shifted matrix (its inertia)."""
    tiny = _EPS * (np.abs(diagonal).max() + np.abs(off).max(initial=0.0) + 1e-300)
    pivot, count = diagonal[0] - shift, 0
    for i in range(len(diagonal)):
        if i:
            pivot = diagonal[i] - shift - off[i - 1] ** 2 / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from the top down, with ``wanted`` eigenvalues at least.

    The spectrum is halved until an interval has few eigenvalues, or is as narrow as rounding.
    """
    diagonal, off = tridiagonal(matrix)
    around = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    top = float((diagonal + around).max())
    scale = max(abs(top), float(np.abs(diagonal).max()))
    low, high = -scale * 1e-9 + min(0.0, float((diagonal - around).min())), top + scale * 1e-9
    found: list[tuple[float, float, int]] = []
    todo = [(low, high, 0, len(matrix))]
    while todo and sum(f[2] for f in found) < wanted:
        a, b, below, under = todo.pop()
        inside = under - below
        if not inside:
            continue
        if inside <= INTERVAL_MOST or b - a < 64 * _EPS * scale * len(matrix):
            found.append((a, b, inside))
            continue
        middle = (a + b) / 2
        count = count_below(diagonal, off, middle)
        todo += [(a, middle, below, count), (middle, b, count, under)]
    return found


def contour(matrix: np.ndarray, low: float, high: float, inside: int) -> tuple[np.ndarray,
                                                                                np.ndarray]:
    """(eigenvalues, unit eigenvectors) in an interval known to hold ``inside`` of them.

    The filter is 1 inside the circle over the interval and falls off outside, so each round
    turns the block towards the eigenvectors inside. It ends when as many Ritz values as the
    inertia counts, with residuals at rounding, lie in the interval.
    """
    n = len(matrix)
    middle, radius = (low + high) / 2, (high - low) / 2
    scale = np.linalg.norm(matrix, 2) if n else 0.0
    angles, weights = np.polynomial.legendre.leggauss(POINTS)
    theta = np.pi / 2 * (1 - angles)  # the upper half; the lower one is its conjugate
    block = np.random.default_rng(n).standard_normal((n, min(n, inside + SPARE)))
    best = None
    for _ in range(FILTER_ROUNDS):
        total = np.zeros_like(block)
        for t, w in zip(theta, weights):
            step = radius * np.exp(1j * t)
            total += w / 2 * np.real(step * np.linalg.solve(
                (middle + step) * np.eye(n) - matrix, block.astype(complex)))
        basis, _ = np.linalg.qr(total)
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turn
        # The inertia says how many there are; of Ritz values at a bound the nearest count.
        near = np.sort(np.argsort(np.abs(values - middle), kind="stable")[:inside])
        error = np.linalg.norm(matrix @ block[:, near] - block[:, near] * values[near],
                               axis=0).max()
        if best is None or error < best[0]:
            best = error, values[near], block[:, near]
        if error <= 8 * _EPS * scale * np.sqrt(n):
            break
    error, values, vectors = best
    edge = 1e-9 * scale
    if error > 1e-8 * scale or values.min() < low - edge or values.max() > high + edge:
        raise ArithmeticError(f"{inside} eigenvalues in [{low}, {high}] were not resolved")
    return values, vectors


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues from the largest down, unit eigenvectors as columns), ``wanted`` at most.

    Eigenvalues that rounding cannot tell from 0 are left out.
    """
    if not len(matrix) or not np.any(matrix):
        return np.zeros(0), np.zeros((len(matrix), 0))
    parts = [contour(matrix, *part) for part in intervals(matrix, min(wanted, len(matrix)))]
    values = np.concatenate([p[0] for p in parts])
    vectors = np.concatenate([p[1] for p in parts], axis=1)
    turn = np.argsort(-values, kind="stable")
    turn = turn[values[turn] > 16 * _EPS * len(matrix) * values.max()][:wanted]
    basis, upper = np.linalg.qr(vectors[:, turn])  # neighbours at a cut are made orthogonal
    return values[turn], basis * np.sign(np.diag(upper))


# --- Sums over the vectors ------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """The fit: count, exact sums, and of every component its vector and eigenvalue."""

    n: int
    sums: np.ndarray       # whole numbers, per dimension
    values: np.ndarray     # eigenvalues, falling
    vectors: np.ndarray    # unit eigenvectors, as columns
    trace: float
    identity_error: float | None


def whole_vectors(rows: DataFrame, vector_col: str, scale: int = SCALE,
                  shift: int = SHIFT) -> DataFrame:
    """The rows with ``x``, floor(scale * entry) + shift, without those that have none.

    Vectors that are null, empty, or with an entry that is null, not finite or beyond
    ``LARGEST`` steps are left out.
    """
    value: Column = F.col(vector_col)
    good = F.forall(value, lambda c: F.coalesce(
        F.abs(c.cast("double")) < LARGEST / scale, F.lit(False)))
    x = F.transform(value, lambda c: F.floor(c.cast("double") * scale).cast("bigint") + shift)
    return rows.where(F.size(value) > 0).where(good).withColumn("x", x)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rows, sums of the entries) of every batch; of a batch, 64 bits hold them."""
    for batch in batches:
        if batch.num_rows:
            total = pa.array([_matrix(batch).sum(axis=0)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows], pa.int64()), total], ["n", "total"])


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, as whole numbers; Python's where 64 bits are too few."""
    if n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0)) < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, rounded once."""
    return _deviations(x, n, sums).astype(np.float64) / n


def _products(fit: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The covariance of the projections of the fit list; the basis may be the identity.

    Every task sends one matrix; Spark adds them up entry by entry.
    """
    wide = basis.shape[1]
    plain = wide == len(basis) and np.array_equal(basis, np.eye(wide))

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide))
        for batch in batches:
            if batch.num_rows:
                centred = _centred(_matrix(batch), n, sums)
                projected = centred if plain else centred @ basis
                total += projected.T @ projected
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.ravel()], pa.list_(pa.float64()))], ["total"])

    parts = fit.mapInArrow(worker, "total array<double>").select(
        F.posexplode("total").alias("at", "value")).groupBy("at").agg(
        F.sum("value").alias("value")).collect()
    matrix = np.zeros(wide * wide)
    for r in parts:
        matrix[r["at"]] = r["value"]
    return matrix.reshape(wide, wide) / n


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` of the rows; None if there are none.

    Copies are dropped inside the tasks before the only shuffle. The distinct vectors are
    written to the shared folder and read three times: for the sums, for the covariance and
    for the check of the result.
    """
    fit = stored(rows.select("x").distinct())
    added = fit.mapInArrow(_sums, "n bigint, total array<bigint>").select(
        "n", F.posexplode("total").alias("at", "value")).groupBy("at").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).orderBy("at").collect()
    if not added:
        return None
    n, sums = added[0]["n"], np.array([int(r["value"]) for r in added], object)
    covariance = _products(fit, n, sums, np.eye(len(sums)))
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading(covariance, components)
    trace, error = float(np.trace(covariance)), None
    if len(values):
        white = _products(fit, n, sums, vectors / np.sqrt(values))
        error = float(np.abs(white - np.eye(len(values))).max())
    return Whitening(n, sums, values, vectors, trace, error)


def whiten(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> tuple[DataFrame, Whitening | None]:
    """(``row, deviation, whitened`` of every vector, the fit).

    ``whitened`` is the array of projections on the components over the roots of their
    eigenvalues; ``deviation`` is the exact sum over dimensions of (n * x - S) ** 2, null
    beyond 64 bits. Vectors that are null, empty, or with an entry that is null, not finite
    or beyond ``LARGEST`` steps are left out. The dimension is that of the most rows (of
    ties the larger); rows of another one are left out. Copies count once in the fit and come
    back as often as they are given. Components without variance are left out, so with one
    distinct vector, as with an empty table, the arrays or the rows are empty. Columns may
    have any names.
    """
    given = rows.select(F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias("row"))
    given = whole_vectors(given.withColumn("v", F.col("row")[vector_col]), "v", scale, shift)
    given = given.select(F.col("row").dropFields(vector_col).alias("row")
                         if len(rows.columns) > 1 else F.lit(None).cast("string").alias("row"), "x")
    common = given.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("d")).first()
    given = given.where(F.size("x") == (common["d"] if common else 0))
    model = fit_whitening(given, components)
    kind = given.schema["row"].dataType.simpleString()
    schema = f"row {kind}, deviation bigint, whitened array<double>"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema), None
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.n, model.sums, model.vectors / np.sqrt(model.values)))

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, basis = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            gaps = _deviations(x, n, sums)
            if gaps.dtype == object or int(np.abs(gaps).max()) ** 2 * len(sums) >= 1 << 63:
                gaps = gaps.astype(object)
            square = [int(s) if s < 1 << 63 else None for s in (gaps * gaps).sum(axis=1)]
            white = _centred(x, n, sums) @ basis
            ends = np.arange(len(x) + 1) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(square, pa.int64()), pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(white.ravel()))],
                ["row", "deviation", "whitened"])

    return given.mapInArrow(worker, schema), model
