"""Embedding whitening with components from FEAST contour integration.

Vectors become integers ``x = floor(1024 * c) + 100000``; counts and sums are
exact, and the covariance comes from values centred before they are multiplied.
The covariance has one row per dimension whatever the table's size; its leading
eigenpairs are found on the driver:

* inertia counts (negative pivots of the shifted tridiagonal form) locate gaps
  and cut the wanted end of the spectrum into intervals with known counts;
* per interval, a quadrature over a circle of complex shifted solves projects a
  subspace onto the interval's eigenvectors, and Rayleigh-Ritz extracts them,
  again until the residuals are at rounding level;
* the pairs found must be as many as the inertia says, else an error is raised.

Every pass over the rows is a partial aggregate per task, of a size set by the
number of dimensions alone; nothing is grouped by key.

Defined results: vectors that are null, empty or hold null or non-finite values
are dropped, and so are entries beyond 2**52 / 1024, which no exact sum could
hold. Of vectors of several lengths, those of the commonest length are used
(the longer among ties). Null ids and repeated rows are kept, each row counts.
An eigenvalue that is zero to rounding gives no component; an empty table, or
one whose vectors are all equal, gives no rows. Columns besides ``vec_id`` and
``embedding`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm.common import stored
from hvault.llm.vectors import scaled, spans

SCALE, OFFSET, BOUND = 1024, 100_000, 1 << 52
COMPONENTS = 8
NODES = 16  # quadrature points on half a circle
GROUP = 16  # eigenvalues looked for in one interval
ROUNDS = 60
EPS = float(np.finfo(float).eps)


# --- eigenpairs of a symmetric matrix -------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the symmetric matrix's tridiagonal form (Householder reflections)."""
    a = np.array(a, float)
    d = len(a)
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues below each shift: negative pivots of the factorisation of the shifted matrix."""
    least = np.finfo(float).tiny / EPS + EPS * EPS * (np.abs(diagonal).max() + (np.abs(off).max() if len(off) else 0.0))
    pivot = diagonal[0] - shifts
    below = (pivot < 0).astype(int)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < least, np.copysign(least, pivot), pivot)
        pivot = diagonal[i] - shifts - off[i - 1] ** 2 / pivot
        below += pivot < 0
    return below


def located(diagonal: np.ndarray, off: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Eigenvalues, falling, to about 1e-9 of the norm by halving intervals on inertia counts; and the norm's bound."""
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    norm = float((np.abs(diagonal) + reach).max())
    d = len(diagonal)
    low, high = np.full(d, -1.01 * norm), np.full(d, 1.01 * norm)
    wanted = d - np.arange(d)  # the eigenvalue of falling place i has d - i - 1 below it
    for _ in range(steps):
        middle = (low + high) / 2
        over = inertia(diagonal, off, middle) >= wanted
        high, low = np.where(over, middle, high), np.where(over, low, middle)
    return (low + high) / 2, norm


def intervals(values: np.ndarray, norm: float, k: int) -> list[tuple[float, float]]:
    """Intervals that hold the ``k`` largest values (more where no gap ends them), cut in the widest gaps."""
    ends = np.concatenate([[1.05 * norm], (values[1:] + values[:-1]) / 2, [-1.05 * norm]])  # end i lies above value i
    gaps = np.concatenate([[norm], values[:-1] - values[1:], [norm]])
    d = len(values)
    near = [c for c in range(k, min(d, k + 8) + 1) if gaps[c] > 1e-4 * norm]
    last = max(near, key=lambda c: gaps[c]) if near else next(c for c in range(k, d + 1) if gaps[c] > 1e-7 * norm)

    def cut(i, j):
        inner = range(i + 1, j)
        c = max(inner, key=lambda c: gaps[c], default=None) if j - i > GROUP else None
        if c is None or gaps[c] <= 1e-7 * norm:
            return [(float(ends[j]), float(ends[i]))]
        return cut(i, c) + cut(c, j)

    return cut(0, last)


def feast(a: np.ndarray, low: float, high: float, count: int, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``a`` with eigenvalues between ``low`` and ``high``."""
    d = len(a)
    size = min(d, max(count + 4, 2 * count))
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(1j * np.pi / 2 * (nodes + 1))  # the upper half; the lower one is its mirror image
    basis = np.random.default_rng(d).standard_normal((d, size))
    eye = np.eye(d)
    for _ in range(ROUNDS):
        projected = np.zeros((d, size))
        for turn, weight in zip(turns, weights):
            z = centre + radius * turn
            projected += weight / 2 * (radius * turn * np.linalg.solve(z * eye - a, basis)).real
        q, _ = np.linalg.qr(projected)
        ritz, inner = np.linalg.eigh(q.T @ a @ q)
        basis = q @ inner
        inside = (ritz > low) & (ritz < high)
        if inside.sum() == count:
            found = basis[:, inside]
            residual = np.linalg.norm(a @ found - found * ritz[inside], axis=0).max(initial=0.0)
            if residual <= 4 * d * EPS * norm:
                return ritz[inside], found
    raise RuntimeError(f"contour integration found {int(inside.sum())} of {count} eigenvalues between {low} and {high}")


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of the symmetric matrix, falling, and unit eigenvectors as columns."""
    k = min(k, len(a))
    diagonal, off = tridiagonal(a)
    values, norm = located(diagonal, off)
    if not k or norm == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    vectors = []
    for low, high in intervals(values, norm, k):
        below = inertia(diagonal, off, np.array([low, high]))
        vectors.append(feast(a, low, high, int(below[1] - below[0]), norm)[1])
    q, _ = np.linalg.qr(np.hstack(vectors))
    ritz, inner = np.linalg.eigh(q.T @ a @ q)
    order = np.argsort(-ritz, kind="stable")[:k]
    return ritz[order], q @ inner[:, order]


# --- passes over the rows ---------------------------------------------------------


@dataclass
class Whitening:
    """Fitted on all usable vectors: sums by dimension (exact), eigenvalues (falling), components as columns, trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.values)


def _rows(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")


def _integers(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    x, at = scaled(batch.column("embedding"), length, SCALE, BOUND)
    return x + OFFSET, at


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of usable vectors of the commonest length and their exact sums by dimension."""

    def run(it):
        count: dict = {}
        total: dict = {}
        for batch in it:
            size, usable = spans(batch.column("embedding"))[2:]
            for length in np.unique(size[usable]).tolist():
                x, _ = _integers(batch, length)
                if not length or not len(x):
                    continue
                count[length] = count.get(length, 0) + len(x)
                high, low = (x >> 26).sum(axis=0), (x & (1 << 26) - 1).sum(axis=0)
                now = [(int(h) << 26) + int(l) for h, l in zip(high, low)]
                total[length] = [a + b for a, b in zip(total[length], now)] if length in total else now
        out = [(length, -1, n) for length, n in count.items()]
        out += [(length, i, s) for length, sums in total.items() for i, s in enumerate(sums)]
        schema = pa.schema([("length", pa.int32()), ("dim", pa.int32()), ("total", pa.decimal128(38, 0))])
        columns = zip(*out) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array([Decimal(v) for v in c] if f.name == "total" else c, f.type) for f, c in zip(schema, columns)], schema=schema)

    parts = rows.select("embedding").mapInArrow(run, "length int, dim int, total decimal(38,0)")
    parts = stored(parts.groupBy("length", "dim").agg(F.sum("total").cast("decimal(38,0)").alias("total")), "totals")
    best = parts.where("dim = -1").orderBy(F.desc("total"), F.desc("length")).first()
    if best is None:
        return 0, []
    found = {r["dim"]: int(r["total"]) for r in parts.where((F.col("length") == best["length"]) & (F.col("dim") >= 0)).collect()}
    return int(best["total"]), [found[i] for i in range(best["length"])]


def second_moments(rows: DataFrame, length: int, values_of, size: int) -> np.ndarray:
    """Sum of outer products of ``values_of(x)``: a matrix per task, one row per pair of dimensions to the driver."""

    def run(it):
        acc = np.zeros((size, size))
        for batch in it:
            x, _ = _integers(batch, length)
            if len(x):
                y = values_of(x)
                acc += y.T @ y
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(acc[i, j], pa.float64())], names=["i", "j", "v"])

    out = np.zeros((size, size))
    for r in rows.select("embedding").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of all usable vectors; None where no component has any variance."""
    rows = _rows(embeddings)
    n, sums = totals(rows)
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    covariance = second_moments(rows, len(sums), lambda x: x - mean, len(sums)) / n
    values, vectors = leading(covariance, components)
    some = values > len(sums) * EPS * float(np.abs(covariance).max())
    if not some.any():
        return None
    return Whitening(n, sums, values[some], vectors[:, some], float(np.trace(covariance)))


def identity_error(embeddings: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.values)

    def with_one(x):
        return np.hstack([model.apply(x), np.ones((len(x), 1))])

    m = second_moments(_rows(embeddings), len(model.sums), with_one, k + 1) / model.n
    return float(np.abs(m[:k, :k] - np.outer(m[k, :k], m[k, :k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over dimensions of ``(n * x - sum) ** 2`` for each row."""
    far = max(n * max(abs(int(x.max())), abs(int(x.min()))), max(abs(s) for s in sums)) if len(x) else 0
    if far < 1 << 62:
        y = n * x - np.array(sums, np.int64)
        most = int(np.abs(y).max()) if len(y) else 0
        if most < 1 << 55 and len(sums) < 1 << 7:
            high, low = y >> 28, y & (1 << 28) - 1  # three exact sums, put together as Python integers
            parts = ((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
            return [(a << 56) + (b << 29) + c for a, b, c in zip(*(p.tolist() for p in parts))]
    y = n * x.astype(object) - np.array(sums, object)
    return (y * y).sum(axis=1).tolist() if len(y) else []


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: see ``OUT``.

    ``deviation_exact`` holds what ``deviation`` holds; ``deviation`` is null where it does not fit a long
    (``deviation_exact``, where it does not fit 38 digits)."""
    model = fit_whitening(embeddings, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], OUT)
    error = identity_error(embeddings, model)
    k, d = len(model.values), len(model.sums)
    explained = model.values / model.trace
    exact = pa.decimal128(38, 0)
    wide = Context(prec=60)

    def run(it):
        for batch in it:
            x, at = _integers(batch, d)
            rows = len(x)
            w = model.apply(x)
            dev = deviations(x, model.n, model.sums)
            place = np.repeat(np.arange(rows), k)
            longs = pa.array([v if v < 1 << 63 else None for v in dev], pa.int64())
            digits = pa.array([wide.create_decimal(v) if v < 10**38 else None for v in dev], exact)
            columns = [
                batch.column("vec_id").take(pa.array(at)).take(pa.array(place)),
                pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                pa.array(np.full(rows * k, model.n), pa.int64()),
                longs.take(pa.array(place)),
                pa.array(w.reshape(-1), pa.float64()),
                pa.array(np.tile(explained, rows), pa.float64()),
                pa.array(np.full(rows * k, error), pa.float64()),
                digits.take(pa.array(place)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUT.split(", ")])

    return _rows(embeddings).mapInArrow(run, OUT)
