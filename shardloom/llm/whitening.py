"""Embedding whitening by a mixed-precision eigendecomposition.

1. Components become whole numbers ``floor(scale * c) + shift``.  Tasks add them up,
   then the products of rows centred at the rounded mean; both are exact whole
   numbers, so the covariance does not depend on how the table is cut.
2. The covariance (its size is the vectors' length squared, whatever the table) has
   its eigenvectors taken in single precision, and Ogita-Aishima iterations correct
   them by matrix products in extended precision: with ``R = I - X'X`` and
   ``S = X'AX`` each step adds ``X E``, where ``E`` divides the residual by the gap of
   the eigenvalues; convergence is quadratic.
3. Eigenvalues closer than the residual can tell apart form a cluster, for which the
   step only makes ``X`` orthogonal.  The cluster's block ``X'(A - mu I)X`` is formed in
   extended precision, where subtracting ``mu`` leaves the small differences, scaled and
   solved on its own, and its rotation put into ``X``; then the iteration goes on.
4. Tasks project every row, and the covariance of what they made is measured.

Defined results: rows whose vector is null or holds null or non-finite components
are left out; vectors of another length than the most frequent one are no part of
the fit and get null ``deviation`` and ``whitened``; values beyond +-2^40 after scaling
are cut there; a deviation beyond a long is the largest long; a component without
variance (constant vectors, fewer rows than dimensions) has ``whitened`` 0, which
``identity_error`` shows; rows without id or with an id of their own twice are rows
like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import common_length, finite, matrix, total_by_position, whole_numbers, written


@dataclass(frozen=True)
class Whitening:
    components: int = 8
    scale: int = 1024
    shift: int = 100_000


CUT = float(2 ** 40)
LARGEST = 2 ** 63 - 1


def whole(column: pa.Array, dim: int, w: Whitening) -> np.ndarray:
    return np.clip(np.floor(matrix(column, dim) * w.scale) + w.shift, -CUT, CUT).astype(np.int64)


# --- eigenvectors (on the driver: the matrix is as large as the vectors are long) --------

HIGH = np.longdouble


def eigenvectors(a: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenvalues (falling), eigenvectors (columns) of a symmetric matrix in extended
    precision, and the number of iterations; both rounded to double precision."""
    a = np.asarray(a, HIGH)
    norm = np.abs(a).max(initial=0)
    if not len(a) or norm == 0:
        return np.zeros(len(a)), np.eye(len(a)), 0
    a = a / norm
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    eye, small = np.eye(len(a), dtype=HIGH), HIGH(np.finfo(np.float64).eps) / 64
    for step in range(1, steps + 1):
        r, s = _residuals(a, x, eye)
        if max(np.abs(r).max(), np.abs(s - np.diag(np.diag(s))).max()) <= small:
            break
        values, change, clusters = _correction(r, s)
        x = x + x @ change
        for members in clusters:
            x[:, members] = x[:, members] @ _sub_solve(a, x[:, members], values[members].mean())
    for _ in range(2):                              # rotations within a cluster leave it a little off
        x = x + x @ _residuals(a, x, eye)[0] / 2
    values = np.diag(x.T @ a @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)      # one sign for all rows
    return (values[order] * norm).astype(np.float64), x.astype(np.float64), step


def _residuals(a: np.ndarray, x: np.ndarray, eye: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``I - X'X`` and ``X'AX``, symmetric to the last bit."""
    r, s = eye - x.T @ x, x.T @ a @ x
    return (r + r.T) / 2, (s + s.T) / 2


def _correction(r: np.ndarray, s: np.ndarray):
    """Eigenvalue estimates, the matrix E of one Ogita-Aishima step, and the clusters it cannot part."""
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    delta = 2 * (np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > delta
    e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
    order = np.argsort(values, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(values[order]) > delta) + 1)
    return values, e, [g for g in groups if len(g) > 1]


def _sub_solve(a: np.ndarray, x: np.ndarray, mu) -> np.ndarray:
    """Rotation that parts the eigenvalues of a cluster around ``mu``; for values
    that are equal to the last bit any basis is one."""
    block = x.T @ (a @ x) - mu * (x.T @ x)
    block = (block + block.T) / 2
    size = np.abs(block).max()
    if size == 0:
        return np.eye(x.shape[1], dtype=HIGH)
    return np.linalg.eigh((block / size).astype(np.float64))[1].astype(HIGH)


# --- passes over the table ----------------------------------------------------------------

def _sums(dim: int, w: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, object), np.zeros(dim, object)
        for b in batches:
            x = whole(b.column("vector"), dim, w)
            n += len(x)
            high, low = high + (x >> 20).sum(axis=0), low + (x & 0xFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([whole_numbers([n, *[(int(h) << 20) + int(v) for h, v in zip(high, low)]])], names=["sums"])
    return run


def _products(dim: int, w: Whitening, centre: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, middle = np.zeros((dim, dim), object), 0, np.array(centre, np.int64)
        for b in batches:
            y = whole(b.column("vector"), dim, w) - middle
            seen += len(y)
            if float(np.abs(y).max(initial=0)) ** 2 * len(y) < 2.0 ** 53:
                f = y.astype(np.float64)
                total = total + (f.T @ f).astype(np.int64)          # whole doubles: exact
            else:
                total = total + y.astype(object).T @ y.astype(object)
        if seen:
            yield pa.RecordBatch.from_arrays([whole_numbers(total.ravel())], names=["products"])
    return run


def _project(dim: int, w: Whitening, centre: list[int], n: int, rest: list[int], weights: np.ndarray):
    """``deviation`` and ``whitened`` of every row; ``rest`` is the sum of the centred rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, left = np.array(centre, np.int64), np.array([r / n for r in rest])
        exact = np.array(rest, object)
        for b in batches:
            y = whole(b.column("vector"), dim, w) - middle
            if dim * (n * (float(np.abs(y).max(initial=0)) + 1)) ** 2 < 2.0 ** 62:
                d = n * y - exact.astype(np.int64)
                deviation = (d * d).sum(axis=1).tolist()
            else:
                d = n * y.astype(object) - exact
                deviation = [min(v, LARGEST) for v in (d * d).sum(axis=1).tolist()] if dim else [0] * len(y)
            z = (y - left) @ weights
            lists = pa.ListArray.from_arrays(np.arange(len(y) + 1, dtype=np.int32) * z.shape[1], pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(deviation, pa.int64()), lists], names=["id", "deviation", "whitened"])
    return run


def covariance(n: int, rest: list[int], products: list[int]) -> np.ndarray:
    """Covariance (divisor n) in extended precision: the exact numerator over n squared."""
    dim = len(rest)
    a = np.empty((dim, dim), HIGH)
    for i in range(dim):
        for j in range(dim):
            a[i, j] = HIGH(n * products[i * dim + j] - rest[i] * rest[j])
    return a / (HIGH(n) * HIGH(n))


def whiten(vectors: DataFrame, w: Whitening = Whitening(), id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, n, deviation, whitened array<double>, explained array<double>, identity_error)`` of every
    usable row; ``whitened`` holds the first ``components`` components."""
    spark = vectors.sparkSession
    rows = vectors.where(finite(vector)).select(F.col(id_column).alias("id"), F.col(vector).alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    dim = common_length(rows, "vector")
    if dim is None:
        return spark.createDataFrame([], f"{id_column} {kind}, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double")
    fit = rows.where(F.size("vector") == dim)
    n, *sums = total_by_position(fit.mapInArrow(_sums(dim, w), "sums array<decimal(38,0)>"), "sums")
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    products = total_by_position(fit.mapInArrow(_products(dim, w, centre), "products array<decimal(38,0)>"), "products")
    values, x, _ = eigenvectors(covariance(n, rest, products))
    k = min(w.components, dim)
    trace = float(values.sum())
    real = values[:k] > trace * dim * np.finfo(np.float64).eps
    weights = np.where(real, x[:, :k] / np.sqrt(np.where(real, values[:k], 1)), 0)
    made = fit.mapInArrow(_project(dim, w, centre, n, rest, weights), f"id {kind}, deviation bigint, whitened array<double>")
    made, _ = written(made, "whitened")
    explained = [float(v / trace) if trace > 0 else 0.0 for v in values[:k]]
    other = rows.where(F.size("vector") != dim).select("id", F.lit(None).cast("bigint").alias("deviation"),
                                                         F.array(*[F.lit(None).cast("double")] * k).cast("array<double>").alias("whitened"))
    return (made.unionByName(other)
            .select(F.col("id").alias(id_column), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                    F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"), F.lit(identity_error(made, k)).alias("identity_error")))


def identity_error(made: DataFrame, k: int) -> float:
    """Largest entry, without sign, of the covariance of ``whitened`` minus the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    if not pairs:
        return 0.0
    got = made.agg(*[F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, got))


def components(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    one = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "one")
    keep = [c for c in whitened.columns if c not in ("whitened", "explained")]
    return whitened.select(*keep, one).select(*keep, (F.col("at") + 1).alias("component"), "one.whitened", "one.explained")


__all__ = ["Whitening", "whiten", "components", "eigenvectors", "covariance", "identity_error"]
