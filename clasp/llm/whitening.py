"""Whitening of embeddings: exact moments, pivoted Cholesky, one-sided Jacobi.

Entries become whole numbers x = floor(1024 c) + 100000, so the moments of
the fit can be exact. One pass counts rows and sums each dimension; a second
centres every entry on the whole number m below its mean and adds up the
products of centred entries, task by task, as whole numbers. The scatter
about the true mean S / n is then

    n^2 V = n * sum (x - m)(x - m)' - (S - n m)(S - n m)'

in whole numbers, rounded once: the result doesn't depend on the order of
rows, tasks or retries. Only moments (d x d for d dimensions) reach the
driver, never rows.

There the scatter is factored, P' V P = L L', by Cholesky steps that take
the largest diagonal left, to its numerical rank. One-sided Jacobi rotates
the columns of L itself until they are orthogonal, L J = U D, so the squared
column norms D^2 are the eigenvalues and the columns of P U the components;
V is never squared or tridiagonalised, which keeps small eigenvalues.

Rows are then whitened, scan by scan, without a shuffle.

Cases: rows whose vector is null or holds null, NaN or infinite entries take
no part. Vectors that are not as long as most of the rest (ties: the longer)
can't share their covariance and take no part either; in a table of one
length there are none. Repeated rows and repeated or null ids are rows of
their own. Where all rows agree there is no component and so no row of
result, likewise for an empty table; components with an eigenvalue of zero
(below d * 2^-52 of the largest) can't be scaled to one and are left out.
Equal eigenvalues leave their components free up to a rotation. Other
columns are ignored. Entries beyond 2^53 after scaling aren't whole doubles
and raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clasp.llm.common import arrow_map, cut

SCALE, OFFSET = 1024, 100_000
EXACT = 1 << 53


@dataclass(frozen=True)
class Whitener:
    """Fitted moments and components."""
    n: int
    sums: tuple[int, ...]  # of x, by dimension
    trace: float
    eigenvalues: np.ndarray  # falling
    components: np.ndarray  # one per row

    @property
    def dims(self) -> int:
        return len(self.sums)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows that take part, as ``id`` and ``v`` (array of double)."""
    entries = F.col(vector_col).cast("array<double>")
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col(id_col).alias("id"), entries.alias("v")).where(F.col("v").isNotNull() & fine)


def _length(rows: DataFrame) -> int:
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return top[0].d if top else 0


def entries_of(column: pa.Array, dims: int) -> np.ndarray:
    """x of every entry, as whole doubles (rows, dims)."""
    c = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dims)
    x = np.floor(c * SCALE) + OFFSET
    if x.size and np.abs(x).max() >= EXACT:
        raise OverflowError("an entry is beyond 2^53 after scaling")
    return x


def whole_products(y: np.ndarray) -> np.ndarray:
    """y' y of whole doubles, exact: in blocks whose sums stay below 2^53
    as doubles, else as Python integers."""
    most = float(np.abs(y).max()) if y.size else 0.0
    block = int(EXACT // max(1.0, most * most))
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    if not block:
        y = y.astype(np.int64).astype(object)
        return y.T @ y + total
    for lo in range(0, len(y), block):
        part = y[lo:lo + block]
        total = total + (part.T @ part).astype(np.int64)
    return total


def _wide(values: np.ndarray) -> pa.Array:
    """Whole numbers of any size up to 38 digits."""
    return pa.array([Decimal(int(v)) for v in values.ravel()], pa.decimal128(38, 0))


def _moment_rows(rows: DataFrame, dims: int, centre: np.ndarray | None) -> DataFrame:
    """(place, value) rows, exact sums over one slice of a task each: entry
    sums by dimension, or products about ``centre`` by d * row + column."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = entries_of(batch.column(0), dims)
        if centre is None:
            values = np.array([sum(map(int, col)) if np.abs(col).sum() >= EXACT else int(col.sum()) for col in x.T], dtype=object)
        else:
            values = whole_products(x - centre)
        return pa.record_batch([pa.array(np.arange(values.size), pa.int64()), _wide(values)], ["place", "value"])
    return arrow_map(rows.select("v"), run, "place long, value decimal(38,0)", step=10_000)


def _sums(rows: DataFrame, size: int) -> list[int]:
    """Added up by place: partial sums in every task, then ``size`` rows."""
    out = [0] * size
    for x in rows.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[x.place] = int(x.value)
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower trapezoidal ``l`` (d x rank) and order ``p`` with
    ``a[p][:, p] = l l'``; each step takes the largest diagonal left."""
    a, d = a.copy(), len(a)
    order, l = np.arange(d), np.zeros((d, d))
    tiny = d * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        at = k + int(np.argmax(a.diagonal()[k:]))
        if not a[at, at] > tiny:
            return l[:, :k], order
        for m in (a, a.T, l):
            m[[k, at]] = m[[at, k]]
        order[[k, at]] = order[[at, k]]
        l[k, k] = np.sqrt(a[k, k])
        l[k + 1:, k] = a[k + 1:, k] / l[k, k]
        a[k + 1:, k + 1:] -= np.outer(l[k + 1:, k], l[k + 1:, k])
    return l, order


def one_sided_jacobi(l: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``l`` with its columns rotated pairwise until all are orthogonal to
    working precision."""
    cols = l.T.copy()  # one column a row: rotations touch whole rows
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for i in range(len(cols) - 1):
            for j in range(i + 1, len(cols)):
                x, y = cols[i], cols[j]
                aa, bb, ab = x @ x, y @ y, x @ y
                if abs(ab) <= eps * np.sqrt(aa * bb):
                    continue
                turned = True
                zeta = (bb - aa) / (2 * ab)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                cols[i], cols[j] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    return cols.T


def principal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a covariance, falling, and their unit
    eigenvectors, one per row (largest entry positive)."""
    l, order = pivoted_cholesky(v)
    turned = one_sided_jacobi(l)
    e = (turned ** 2).sum(axis=0)
    rank = np.argsort(-e, kind="stable")
    rank = rank[e[rank] > len(v) * np.finfo(float).eps * e.max(initial=0.0)]
    out = np.zeros((len(rank), len(v)))
    out[:, order] = (turned[:, rank] / np.sqrt(e[rank])).T
    for u in out:
        u *= -1.0 if u[np.argmax(np.abs(u))] < 0 else 1.0
    return e[rank], out


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitener:
    """Moments of all rows that take part, and all components."""
    rows = usable(vectors, id_col, vector_col)
    dims = _length(rows)
    rows = rows.where(F.size("v") == dims)
    n = rows.count() if dims else 0
    if not n:
        return Whitener(0, (0,) * dims, 0.0, np.zeros(0), np.zeros((0, dims)))
    sums = _sums(_moment_rows(rows, dims, None), dims)
    floors = [s // n for s in sums]
    products = _sums(_moment_rows(rows, dims, np.array(floors, dtype=np.float64)), dims * dims)
    left = [s - n * m for s, m in zip(sums, floors)]  # sums of the centred entries, 0 <= left < n
    v = np.array([[(n * products[i * dims + j] - left[i] * left[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    e, components = principal(v)
    return Whitener(n, tuple(sums), float(np.trace(v)), e, components)


def transform(vectors: DataFrame, model: Whitener, components: int = 8, id_col: str = "vec_id",
              vector_col: str = "embedding") -> DataFrame:
    """Per row that takes part: its id, ``deviation`` = sum (n x - S)^2,
    exact, and ``whitened``, an array of up to ``components`` numbers."""
    rows = usable(vectors, id_col, vector_col).where(F.size("v") == max(model.dims, 1))
    n, dims, k = model.n, model.dims, min(components, len(model.eigenvalues))
    id_type = vectors.schema[id_col].dataType.simpleString()
    # x - S/n = (x - m) - (S - n m)/n: both terms small, so nothing is rounded away
    floors = np.array([s // n for s in model.sums] if n else [], dtype=np.float64)
    rest = np.array([(s % n) / n for s in model.sums] if n else [])
    left = [s % n for s in model.sums] if n else []
    turn = (model.components[:k] / np.sqrt(model.eigenvalues[:k])[:, None]).T if k else np.zeros((dims, 0))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        y = entries_of(batch.column(1), dims) - floors
        far = n * (float(np.abs(y).max()) + 1) if y.size else 0.0
        if far * far * dims < 2.0 ** 62:
            deviation = ((n * y.astype(np.int64) - np.array(left, dtype=np.int64)) ** 2).sum(axis=1)
        else:
            deviation = ((n * y.astype(np.int64).astype(object) - np.array(left, dtype=object)) ** 2).sum(axis=1)
        white = (y - rest) @ turn
        offsets = pa.array(np.arange(len(y) + 1) * k, pa.int32())
        return pa.record_batch([batch.column(0), _wide(deviation), pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))],
                               ["id", "deviation", "whitened"])
    return arrow_map(rows, run, f"id {id_type}, deviation decimal(38,0), whitened array<double>", step=10_000).select(
        F.col("id").alias(id_col), "deviation", "whitened")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus
    the identity: their means first, then products of centred numbers."""
    if not k:
        return 0.0
    w = [F.col("whitened")[i] for i in range(k)]
    means = white.agg(*[F.avg(c).alias(str(i)) for i, c in enumerate(w)]).first()
    centred: list[Column] = [c - F.lit(float(m)) for c, m in zip(w, means)]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    found = white.agg(*[F.avg(centred[i] * centred[j]).alias(f"{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found))


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector that takes part and component: id, ``component``
    (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` (share of the
    trace) and ``identity_error``, measured on the written rows."""
    model = fit(vectors, id_col, vector_col)
    white = cut(transform(vectors, model, components, id_col, vector_col), "whitened")
    k = min(components, len(model.eigenvalues))
    error = identity_error(white, k)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues[:k]]).cast("array<double>")
    return white.select(F.col(id_col), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        id_col, (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"))
