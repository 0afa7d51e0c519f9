"""Whitening of embeddings: pivoted Cholesky of the scatter, then one-sided Jacobi on its factor.

Entries become whole numbers ``floor(SCALE * c)``. The model is fitted on every distinct vector
once; which copies there are does not matter. Spark makes vectors distinct and adds up sums
and the scatter of centred vectors, task by task; what reaches the driver is one number per
dimension and one per pair of dimensions. There

1. the covariance is factored as ``V = L L^T`` with pivoting, so ``L`` is triangular in the
   order of the pivots and has as many columns as ``V`` has rank;
2. rotations of pairs of columns of ``L`` itself make its columns orthogonal. The squared
   norms of the rotated columns are the eigenvalues, the normalised columns the components.

Centring is exact: sums are whole numbers of any size, and a vector loses the whole part of
the mean in integers and the rest in doubles.

Cases: a NULL vector, one with a NULL or non-finite entry, an empty one, and one whose length
is not the most frequent length (the greatest of those, if several are) are dropped. Repeated
rows and rows with a NULL id give a row each. Fewer than ``components`` dimensions give so many
components; one without variance has ``explained`` 0 (NULL if no component has any) and
``whitened`` NULL. Of components with the same eigenvalue either may come first. ``deviation``
is NULL where it exceeds a long. An empty table gives an empty result. Only the named columns
are read, so other names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import Rows
from corpusprep.session import materialise

SCALE = 256
COMPONENTS = 4
BATCH = 4096
EPS = np.finfo(np.float64).eps
LONG = 2**63 - 1


@dataclass(frozen=True)
class Moments:
    """Of the fit list: the number of vectors and the sum of every dimension."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n


@dataclass(frozen=True)
class Whitening:
    moments: Moments
    eigenvalues: np.ndarray
    components: np.ndarray  # one column each
    trace: float


def finite_vectors(rows: DataFrame, key: str | Column, vec: str) -> DataFrame:
    """``(key, x)`` of rows whose vector is complete; ``x`` are its whole numbers."""
    entry = lambda c: c.cast("double")
    bad = F.exists(F.col(vec), lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) == float("inf")))
    whole = F.transform(F.col(vec), lambda c: F.floor(F.lit(float(SCALE)) * entry(c)).cast("bigint"))
    return rows.filter(F.col(vec).isNotNull() & (F.size(vec) > 0) & ~bad).select(key, whole.alias("x"))


def usual_length(vectors: DataFrame) -> int | None:
    found = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return None if found is None else found["d"]


def matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The vectors of a batch, a row each."""
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)


def pieces(batches: Rows):
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            yield batch.slice(start, BATCH)


def moments(distinct: DataFrame, d: int) -> Moments:
    def add(batches: Rows) -> Rows:
        n, sums = 0, [0] * d
        for piece in pieces(batches):
            x = matrix(piece, d)
            n += len(x)
            # Halves of 32 bits add up without overflow.
            low, high = (x & 0xFFFFFFFF).sum(0).tolist(), (x >> 32).sum(0).tolist()
            sums = [s + a + (b << 32) for s, a, b in zip(sums, low, high)]
        if n:
            yield pa.record_batch(
                [pa.array(range(-1, d), pa.int32()), pa.array([str(v) for v in (n, *sums)])], ["i", "v"])

    rows = distinct.mapInArrow(add, "i int, v string").groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(28,0)")).cast("string").alias("v")).collect()
    found = {r["i"]: int(r["v"]) for r in rows}
    return Moments(found[-1], tuple(found[i] for i in range(d)))


def covariance(distinct: DataFrame, m: Moments) -> np.ndarray:
    """Centred before multiplying; added up per task, then over tasks in Spark."""
    d = len(m.sums)
    upper = np.triu_indices(d)

    def add(batches: Rows) -> Rows:
        total = np.zeros((d, d))
        for piece in pieces(batches):
            y = m.centred(matrix(piece, d))
            total += y.T @ y
        yield pa.record_batch(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], ["i", "j", "v"])

    out = np.zeros((d, d))
    for r in distinct.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / m.n
    return out


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(factor, order)``: ``v[order][:, order] = factor @ factor.T``, the factor lower triangular.

    It has a column for every pivot that is more than rounding of the largest diagonal entry.
    """
    left, order = np.array(v, np.float64), np.arange(len(v))
    factor = np.zeros_like(left)
    least = len(v) * EPS * max(float(np.max(np.diag(left), initial=0.0)), 0.0)
    for k in range(len(v)):
        best = k + int(np.argmax(np.diag(left)[k:]))
        if not left[best, best] > least:
            return factor[:, :k], order
        if best != k:
            both, swapped = [k, best], [best, k]
            left[both] = left[swapped]
            left[:, both] = left[:, swapped]
            factor[both] = factor[swapped]
            order[both] = order[swapped]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1:, k] = left[k + 1:, k] / factor[k, k]
        left[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms and directions of the factor's columns, rotated until they are orthogonal."""
    a = np.array(factor, order="F")
    n = a.shape[1]
    for _ in range(sweeps):
        turned = False
        for p in range(n - 1):
            # The column with the greatest norm goes first.
            best = p + int(np.argmax(np.einsum("ij,ij->j", a[:, p:], a[:, p:])))
            a[:, [p, best]] = a[:, [best, p]]
            for q in range(p + 1, n):
                x, y = a[:, p], a[:, q]
                xx, yy, xy = x @ x, y @ y, x @ y
                if abs(xy) <= EPS * np.sqrt(xx * yy) or xy == 0:
                    continue
                turned = True
                zeta = (yy - xx) / (2 * xy)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                s = c * t
                a[:, p], a[:, q] = c * x - s * y, s * x + c * y
        if not turned:
            break
    norms = np.sqrt(np.einsum("ij,ij->j", a, a))
    by = np.argsort(-norms, kind="stable")
    return norms[by] ** 2, a[:, by] / norms[by]


def fit(distinct: DataFrame, d: int) -> Whitening:
    m = moments(distinct, d)
    v = covariance(distinct, m)
    factor, order = pivoted_cholesky(v)
    eigenvalues, turned = one_sided_jacobi(factor)
    components = np.zeros((d, turned.shape[1]))
    components[order] = turned
    return Whitening(m, eigenvalues, components, float(np.trace(v)))


def projector(model: Whitening, k: int) -> tuple[np.ndarray, int]:
    """What centred vectors are multiplied by, and how many components it has."""
    some = min(k, len(model.eigenvalues))
    return model.components[:, :some] / np.sqrt(model.eigenvalues[:some]), some


def identity_error(distinct: DataFrame, model: Whitening, k: int) -> float | None:
    """How far the covariance of the whitened fit list is from the identity; NULL without components."""
    into, some = projector(model, k)
    if not some:
        return None
    m, d = model.moments, len(model.moments.sums)
    names = [f"z{i}" for i in range(some)]

    def run(batches: Rows) -> Rows:
        for piece in pieces(batches):
            z = m.centred(matrix(piece, d)) @ into
            yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in z.T], names)

    pairs = [(i, j) for i in range(some) for j in range(i, some)]
    found = distinct.mapInArrow(run, ", ".join(f"{n} double" for n in names)).agg(
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def deviations(x: np.ndarray, m: Moments) -> list[int | None]:
    """The exact sum of ``(n x - S)^2`` of each vector."""
    y, rest, n = x - m.whole, m.rest, m.n
    most = (int(np.abs(y).max(initial=0)) + 1) * n
    if most * most * x.shape[1] <= LONG:
        return ((y * n - rest) ** 2).sum(1).tolist()
    exact = ((y.astype(object) * n - rest.astype(object)) ** 2).sum(1)
    return [int(v) if v <= LONG else None for v in exact]


def whiten(
    rows: DataFrame, key: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS,
) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)``, a row per vector and component."""
    kind = rows.schema[key].dataType.simpleString()
    schema = (f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    vectors = finite_vectors(rows, F.col(key).alias("key"), vec)
    d = usual_length(vectors)
    if d is None:
        return rows.sparkSession.createDataFrame([], schema)
    vectors = vectors.filter(F.size("x") == d)
    distinct = materialise(vectors.select("x").distinct(), "fit-list")
    model = fit(distinct, d)
    error = identity_error(distinct, model, components)
    into, some = projector(model, components)
    m, every = model.moments, min(components, d)
    share = [float(e / model.trace) for e in model.eigenvalues[:some]]
    share += [0.0 if model.trace > 0 else None] * (every - some)

    def run(batches: Rows) -> Rows:
        for piece in pieces(batches):
            x = matrix(piece, d)
            z = m.centred(x) @ into
            apart = pa.array(deviations(x, m), pa.int64())
            for i in range(every):
                count = len(x)
                value = pa.array(np.ascontiguousarray(z[:, i])) if i < some else pa.nulls(count, pa.float64())
                yield pa.record_batch(
                    [piece.column("key"), pa.array([i + 1] * count, pa.int32()), pa.array([m.n] * count, pa.int64()),
                     apart, value, pa.array([share[i]] * count, pa.float64()),
                     pa.array([error] * count, pa.float64())],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
