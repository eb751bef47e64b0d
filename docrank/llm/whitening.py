"""Embedding whitening: the leading principal components by FEAST contour integration.

Vectors become integers first (``floor(256 * c)``), so equal vectors are equal exactly.
Every distinct vector counts once.  Spark sums the distinct vectors, then the products
of their centred entries (one pass each over a stored table); what reaches the driver
is a matrix of dimensions x dimensions, whatever the number of vectors.

There the components are found by contour integration.  Householder reduction to a
tridiagonal matrix gives inertia counts: the number of negative pivots of T - s is the
number of eigenvalues below s.  Bisection on these counts bounds the wanted upper end
of the spectrum, and cuts it into intervals at its gaps.  For each interval the
spectral projector is a quadrature of (z - V)^-1 over points z of a circle through the
interval's ends, applied to a block of vectors; Rayleigh-Ritz within the projected
subspace gives eigenpairs, and the step repeats until the residuals are at rounding.
The number found must equal the inertia count of the interval; otherwise the block
grows.

Defined results: vectors that are null, empty or hold null or non-finite entries are
left out, and so are those of another length than the most frequent one (ties: the
smaller); null and repeated ids pass through, one set of rows each; a component whose
eigenvalue is not above rounding (``d * eps * trace``) has no whitened value and gives no
rows, so equal vectors only, one vector or an empty table give an empty result;
``deviation`` is null where it exceeds a long; columns other than the named ones are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm.common import store
from docrank.llm.vectors import as_doubles, common_dim

SCALE = 256
COMPONENTS = 4
POINTS = 16                # quadrature points on the upper half circle
SWEEPS = 30
STEP_ROWS = 4_096          # rows that a task multiplies at a time
LEAST_GAP = 1e-6           # of the spectrum's bound, between two intervals
EPS = float(np.finfo(float).eps)
EXACT = 2**53


# ---- eigenpairs ----------------------------------------------------------------
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to ``a``."""
    a = np.array(a, float)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            continue
        x[0] += norm if x[0] >= 0 else -norm
        v = x / np.linalg.norm(x)
        a[k + 1:, k:] -= 2 * np.outer(v, v @ a[k + 1:, k:])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_below(diag: np.ndarray, off: np.ndarray, s: float) -> int:
    """Inertia: eigenvalues of the tridiagonal matrix below ``s``, which are the negative
    pivots of its LDL^T factors after the shift."""
    tiny = EPS * (np.abs(diag).max(initial=0) + np.abs(off).max(initial=0)) + np.finfo(float).tiny
    below, pivot = 0, 1.0
    for i, d in enumerate(diag):
        pivot = d - s - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        below += pivot < 0
    return below


def upper_intervals(diag: np.ndarray, off: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Intervals ``(a, b, eigenvalues in it)``, from the top, that hold the ``k`` largest
    eigenvalues (and those equal to the last).  Ends lie in gaps of the spectrum."""
    n = len(diag)
    reach = np.abs(diag) + np.r_[np.abs(off), 0] + np.r_[0, np.abs(off)]
    top = float(reach.max()) * (1 + 4 * EPS) or 1.0
    low = -top

    def edges(j: int) -> tuple[float, float]:
        """Below and above the j-th largest eigenvalue, as near as rounding tells."""
        a, b = low, top
        while b - a > 8 * EPS * top:
            mid = (a + b) / 2
            if mid in (a, b):
                break
            a, b = (mid, b) if n - count_below(diag, off, mid) >= j else (a, mid)
        return a, b

    at = [edges(1)]
    out, upper, first, done = [], top * (1 + 1e-3), 0, 0
    while done < k and done < n:
        j = len(at)
        if j < n:
            at.append(edges(j + 1))
            gap = at[j - 1][0] - at[j][1]
            # a gap that keeps the circles apart, and eigenvectors of both sides orthogonal
            if gap < max(0.05 * (at[first][1] - at[j - 1][0]), LEAST_GAP * top):
                continue
            lower = at[j - 1][0] - gap / 2
        else:
            lower = at[-1][0] - max(0.25 * abs(at[-1][0]), 64 * EPS * top)
        done = n - count_below(diag, off, lower)
        out.append((lower, upper, done - first))
        upper, first = lower, done
    return out


def feast(v: np.ndarray, a: float, b: float, count: int, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of the symmetric ``v`` with eigenvalues in (a, b), largest
    first."""
    n = len(v)
    x, w = np.polynomial.legendre.leggauss(points)
    angle = np.pi / 2 * (1 + x)                     # the upper half; the lower one is conjugate
    mid, radius = (a + b) / 2, (b - a) / 2
    z = mid + radius * np.exp(1j * angle)
    scale = np.abs(v).max()
    shifted = [np.linalg.inv(s * np.eye(n) - v) for s in z]
    columns = min(n, count + max(4, count // 2))
    while True:
        block = np.random.default_rng(columns).standard_normal((n, columns))
        for _ in range(SWEEPS):
            # 1 / (2 pi i) of the contour integral, by the symmetry of the two halves
            q = sum((0.5 * wj * radius * np.exp(1j * t) * (s @ block)).real for wj, t, s in zip(w, angle, shifted))
            q, _ = np.linalg.qr(q)
            small = q.T @ v @ q
            e, y = np.linalg.eigh((small + small.T) / 2)
            block = q @ y
            inside = np.flatnonzero((e > a) & (e < b))
            residual = np.linalg.norm(v @ block[:, inside] - block[:, inside] * e[inside], axis=0)
            if len(inside) == count and (residual <= 64 * EPS * scale * np.sqrt(n)).all():
                at = inside[::-1]
                return e[at], block[:, at]
        if columns == n:
            raise ArithmeticError(f"{len(inside)} of {count} eigenvalues found in ({a}, {b})")
        columns = min(n, 2 * columns)


def leading(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The at most ``k`` largest eigenvalues above rounding, and unit eigenvectors as
    columns; the largest entry of each is positive."""
    trace = float(np.trace(v))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    scale = float(np.abs(v).max())
    v = (v + v.T) / (2 * scale)
    diag, off = tridiagonal(v)
    pairs = [feast(v, a, b, count) for a, b, count in upper_intervals(diag, off, min(k, len(v))) if count]
    e = np.concatenate([x for x, _ in pairs])[:k] * scale
    y = np.concatenate([x for _, x in pairs], axis=1)[:, :k]
    good = e > len(v) * EPS * trace
    e, y = e[good], y[:, good]
    sign = np.sign(y[np.abs(y).argmax(axis=0), np.arange(y.shape[1])])
    return e, y * sign


# ---- sums over the distinct vectors ---------------------------------------------------
def integer_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """``vec_id, x`` (integers) of the rows that take part, and their dimensions."""
    dim = common_dim(table, vec_col)
    v = as_doubles(vec_col)
    good = F.coalesce((F.size(v) == dim) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False))
    rows = table.where(good) if dim else table.where(F.lit(False))
    return rows.select(F.col(id_col).alias("vec_id"), F.transform(v, lambda c: F.floor(c * SCALE).cast("long")).alias("x")), dim


def rows_of(batches, dim: int) -> Iterator[np.ndarray]:
    """The vectors of the batches' last column, ``STEP_ROWS`` at a time."""
    for b in batches:
        for i in range(0, b.num_rows, STEP_ROWS):
            part = b.slice(i, STEP_ROWS)
            yield part.column(part.num_columns - 1).flatten().to_numpy().reshape(-1, dim)


def column_sums(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    def run(batches):
        n, s = 0, [0] * dim
        for x in rows_of(batches, dim):
            n += len(x)
            part = x.sum(axis=0) if np.abs(x.astype(float)).max(initial=0) < 2**48 else x.astype(object).sum(axis=0)
            s = [a + int(c) for a, c in zip(s, part)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array(map(str, [n, *s]), pa.string())], names=["at", "s"])
    got = {r["at"]: int(r.s) for r in distinct.select("x").mapInArrow(run, "at int, s string")
           .groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return got.get(-1, 0), [got.get(i, 0) for i in range(dim)]


def product_sums(distinct: DataFrame, dim: int, centred, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products of ``centred(x)`` (rows of ``width`` doubles) over the
    distinct vectors.  Tasks send ``width`` rows of ``width`` sums; they are merged by row
    number, so the driver gets one matrix."""
    def multiply(batches):
        total, n = np.zeros((width + 1, width)), 0
        for x in rows_of(batches, dim):
            y = centred(x)
            total[:width] += y.T @ y
            total[width] += y.sum(axis=0)
            n += len(x)
        if n:
            yield batch(range(width + 1), total)

    def add(batches):
        at, total = None, np.zeros(width)
        for b in batches:
            sums = b.column("s").flatten().to_numpy().reshape(-1, width)
            for i, s in zip(b.column("at").to_pylist(), sums):
                if i != at:
                    if at is not None:
                        yield batch([at], total[None])
                    at, total = i, np.zeros(width)
                total = total + s
        if at is not None:
            yield batch([at], total[None])

    def batch(at, sums) -> pa.RecordBatch:
        rows = pa.ListArray.from_arrays(np.arange(len(sums) + 1, dtype=np.int32) * width, pa.array(sums.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), rows], names=["at", "s"])

    schema = "at int, s array<double>"
    parts = distinct.select("x").mapInArrow(multiply, schema)
    out = np.zeros((width + 1, width))
    for r in parts.repartition("at").sortWithinPartitions("at", "s").mapInArrow(add, schema).collect():
        out[r["at"]] = r.s
    return out[width], out[:width]


@dataclass
class Whitener:
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as a whole and a remaining part, each a double exactly or nearly so."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        return whole, np.array([(s % self.n) / self.n for s in self.sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self.centre
        return ((x - whole).astype(float) - rest) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact squared distances from the mean, times n squared."""
        reach = self.n * float(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, self.sums), default=0)
        if reach * reach * x.shape[1] < 2**62:
            d = self.n * x - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * x.astype(object) - np.array(self.sums, object)
        return [int(s) if s < 2**63 else None for s in (d * d).sum(axis=1)]


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of a stored table of distinct integer vectors ``x``."""
    n, sums = column_sums(distinct, dim)
    if not n:
        return None
    whole, rest = Whitener(n, sums, None, None, 0.0).centre
    # entries less the whole part of the mean are small integers, whose products and sums
    # are exact below 2^53; what is left of the mean is below one
    _, products = product_sums(distinct, dim, lambda x: (x - whole).astype(float), dim)
    v = products / n - np.outer(rest, rest)
    values, vectors = leading(v, components)
    return Whitener(n, sums, values, vectors, float(np.trace(v)))


def identity_error(distinct: DataFrame, dim: int, w: Whitener) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = len(w.values)
    sums, products = product_sums(distinct, dim, w, k)
    mean = sums / w.n
    return float(np.abs(products / w.n - np.outer(mean, mean) - np.eye(k)).max())


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: see the module."""
    rows, dim = integer_vectors(table, id_col, vec_col)
    distinct = store(rows.select("x").distinct(), "distinct-vectors")
    w = fit(distinct, dim, components) if dim else None
    if w is None or not len(w.values):
        return table.sparkSession.createDataFrame([], WHITENED)
    error, k = identity_error(distinct, dim, w), len(w.values)

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, STEP_ROWS):
                part = b.slice(i, STEP_ROWS)
                x = part.column(1).flatten().to_numpy().reshape(-1, dim)
                again, m = np.repeat(np.arange(len(x)), k), len(x) * k
                yield pa.RecordBatch.from_arrays([
                    part.column(0).cast(pa.int64()).take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(m, w.n)), pa.array(w.deviation(x), pa.int64()).take(pa.array(again)), pa.array(w(x).ravel()),
                    pa.array(np.tile(w.values / w.trace, len(x))), pa.array(np.full(m, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, WHITENED)
