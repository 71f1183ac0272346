"""Whitening of embeddings on an exact integer scatter.

Entries become integers x = floor(1024 * c) + 100000.  Sums are exact; with the
rounded means m they give y = x - m, whose sums of products are exact as well
(products of 20-bit limbs, in blocks short enough for doubles to hold them).
n * sum(y y') - t t', with t = sum(y), is the scatter about the exact mean.

Tasks hand on one matrix each, as rows (i, j, value) that Spark adds up; the
driver holds one matrix of the embedding's dimension.  There a pivoted Cholesky
factorisation gives a triangular factor, and one-sided Jacobi rotations make its
columns orthogonal: squared column norms are the eigenvalues of the covariance
and normalised columns the components."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .vectors import matrix, usable

SCALE, SHIFT = 1024, 100_000
#: Largest |1024 * c| whose floor a double holds exactly.
LARGEST = 2.0**53
LIMB = 20
#: Rows whose 20-bit products add up below 2**53.
BLOCK = 8192
SUMS = "i int, j int, value decimal(38,0)"
OUT = "vec_id long, deviation long, whitened array<double>"


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: exact sums of the x-vectors, eigenvalues (falling)
    with their share of the trace, and components as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    explained: np.ndarray
    components: np.ndarray

    @property
    def means(self) -> np.ndarray:
        """The means, rounded to integers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """Sums of x minus the rounded means."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.means)]


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors.astype(np.float64)).astype(np.int64) + SHIFT


def _rows(i, j, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                       pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))], names=["i", "j", "value"])


def _limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as sums of limbs << (bits * k); only the last one has a sign."""
    out = []
    while x.size and (x.max() >= 1 << bits or x.min() < -(1 << bits)):
        out.append(x & ((1 << bits) - 1))
        x = x >> bits
    return [*out, x]


def products(y: np.ndarray) -> np.ndarray:
    """y' y exactly, as Python integers."""
    total = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), BLOCK):
        parts = [p.astype(np.float64) for p in _limbs(y[at:at + BLOCK], LIMB)]
        for a, left in enumerate(parts):
            for b, right in enumerate(parts):
                total += (left.T @ right).astype(np.int64).astype(object) * (1 << LIMB * (a + b))
    return total


def squares(v: np.ndarray) -> np.ndarray:
    """Sum of squares of each row exactly, as Python integers."""
    parts, total = _limbs(v, 21), np.zeros(len(v), object)
    for a, left in enumerate(parts):
        for b, right in enumerate(parts):
            total += (left * right).sum(1).astype(object) * (1 << 21 * (a + b))
    return total


def _sums(vectors: DataFrame, dim: int) -> list[int]:
    def run(batches):
        total = np.zeros(dim, object)
        for batch in batches:
            for part, x in enumerate(_limbs(integers(matrix(batch.column(0), dim)), LIMB)):
                total += x.sum(0).astype(object) * (1 << LIMB * part)
        yield _rows(range(dim), [0] * dim, total)

    found = vectors.select("vec").mapInArrow(run, SUMS).groupBy("i").agg(F.sum("value").alias("value")).collect()
    by = {r["i"]: int(r["value"]) for r in found}
    return [by[i] for i in range(dim)]


def _scatter(vectors: DataFrame, dim: int, means: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of products of y = x - means for i <= j."""
    i, j = np.triu_indices(dim)

    def run(batches):
        total = np.zeros((dim, dim), object)
        for batch in batches:
            total += products(integers(matrix(batch.column(0), dim)) - means)
        yield _rows(i, j, total[i, j])

    found = vectors.select("vec").mapInArrow(run, SUMS).groupBy("i", "j").agg(F.sum("value").alias("value"))
    return {(r["i"], r["j"]): int(r["value"]) for r in found.collect()}  # dim * (dim + 1) / 2 rows


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L) with a[order][:, order] = L L', L lower triangular with as
    many columns as `a` has rank to double precision."""
    a, d = a.copy(), len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * max(a.diagonal().max(initial=0), 0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= least:
            return order, factor[:, :k]
        for x in (a, a.T, factor):  # rows, columns, rows found so far
            x[[k, p]] = x[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k:, k] = a[k:, k] / np.sqrt(a[k, k])
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return order, factor


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """`factor` times a rotation, with orthogonal columns.  Each round rotates
    disjoint pairs of columns; a sweep meets all pairs."""
    r = factor.shape[1]
    w = np.zeros((r + r % 2, factor.shape[0]))
    w[:r] = factor.T
    seats = np.arange(len(w))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(max(1, len(w) - 1)):
            p, q = seats[:len(w) // 2], seats[len(w) // 2:][::-1]
            wp, wq = w[p], w[q]
            a, b, c = (wp * wp).sum(1), (wq * wq).sum(1), (wp * wq).sum(1)
            size = np.sqrt(a) * np.sqrt(b)
            turn = np.abs(c) > 1e-15 * size
            if turn.any():
                worst = max(worst, float((np.abs(c[turn]) / size[turn]).max()))
                zeta = (b[turn] - a[turn]) / (2 * c[turn])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                cos = (1 / np.hypot(1, t))[:, None]
                sin = cos * t[:, None]
                w[p[turn]], w[q[turn]] = cos * wp[turn] - sin * wq[turn], sin * wp[turn] + cos * wq[turn]
            seats[1:] = np.roll(seats[1:], 1)
        if worst < 1e-14:
            break
    return w[:r].T


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues, falling, and unit eigenvectors as columns; each
    one's entry of largest size is positive."""
    order, factor = pivoted_cholesky(covariance)
    columns = np.empty_like(factor)
    columns[order] = jacobi_columns(factor)
    norms = np.sqrt((columns * columns).sum(0))
    by = np.argsort(-norms, kind="stable")
    norms, columns = norms[by], columns[:, by] / norms[by]
    signs = np.where(columns[np.abs(columns).argmax(0), np.arange(columns.shape[1])] < 0, -1.0, 1.0) if len(by) else 1.0
    return norms**2, columns * signs


def fit(vectors: DataFrame, n: int, dim: int) -> Whitening:
    sums = _sums(vectors, dim)
    plain = Whitening(n, sums, np.empty(0), np.empty(0), np.empty((dim, 0)))
    found, t = _scatter(vectors, dim, plain.means), plain.rest
    covariance = np.empty((dim, dim))
    for (i, j), v in found.items():
        covariance[i, j] = covariance[j, i] = (n * v - t[i] * t[j]) / n**2  # a quotient of integers, rounded once
    values, components = eigen(covariance)
    return Whitening(n, sums, values, values / covariance.trace(), components)


def transform(vectors: DataFrame, dim: int, fitted: Whitening, components: int) -> DataFrame:
    """(vec_id, deviation, whitened): whitened has an entry per component."""
    n, means, rest = fitted.n, fitted.means, fitted.rest
    centre, rest = np.array([t / n for t in rest]), np.array(rest, object)
    axes = fitted.components[:, :components] / np.sqrt(fitted.values[:components])

    def deviations(y):
        if int(np.abs(y).max(initial=0) + 1) * n < 2**62:
            return squares(n * y - rest.astype(np.int64))
        return ((n * y.astype(object) - rest) ** 2).sum(1)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                y = integers(matrix(part.column(1), dim)) - means
                w = (y - centre) @ axes
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([v if v < 2**63 else None for v in deviations(y)], pa.int64()),
                     pa.array(list(w), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    return vectors.select("vec_id", "vec").mapInArrow(run, OUT)


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance (divisor n) of `whitened` minus the identity."""
    at = [F.col("whitened")[k] for k in range(components)]
    cells = [F.abs(F.covar_pop(at[a], at[b]) - F.lit(float(a == b))) for a in range(components) for b in range(a, components)]
    return float(whitened.agg(F.greatest(*cells, F.lit(0.0)).alias("e")).first()["e"])


def whiten(rows: DataFrame, components: int = 8) -> DataFrame:
    """One row per usable row of `rows` (vec_id, embedding) and component, up to
    `components` of them: vec_id, component (from 1, by falling eigenvalue), n,
    deviation, whitened, explained, identity_error.

    The fit list is all usable rows (:func:`vectors.usable`) whose entries have
    an exact x, that is |1024 * c| below 2**53; repeated rows count as often as
    they occur, each with rows of its own, and a NULL vec_id stays NULL.
    Components of eigenvalue zero (equal vectors, fewer vectors than
    `components`) can't be whitened and have no rows; an empty table has none
    at all.  A deviation that no long holds is NULL."""
    spark = rows.sparkSession
    exact = rows.select("vec_id", F.when(F.forall("embedding", lambda c: F.abs(c.cast("double") * SCALE) < F.lit(LARGEST)),
                                         F.col("embedding")).alias("embedding"))
    vectors, n, dim = usable(exact)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n:
        return spark.createDataFrame([], schema)
    fitted = fit(vectors, n, dim)
    k = min(components, len(fitted.values))
    if not k:
        return spark.createDataFrame([], schema)
    stored, _ = store(transform(vectors, dim, fitted, k), "whitened")
    error = identity_error(stored, k)
    share = F.array(*(F.lit(float(x)) for x in fitted.explained[:k]))
    return stored.select("vec_id", "deviation", F.posexplode("whitened").alias("c", "whitened")).select(
        "vec_id", (F.col("c") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("c")).alias("explained"), F.lit(error).alias("identity_error"))
