"""Whitening components of embeddings by shifted Cholesky QR.

Entries are put on a lattice, x = floor(64 * c) + 1000000, and every distinct
x vector counts once (the fit list).  Its rows, centred exactly (n * x - S in
whole numbers, divided once), are a tall matrix A.  Passes over the fit list
work out the Gram matrix of A, then of A after triangular solves with the
Cholesky factors found so far, until the columns are orthonormal: the first
factor, and any that Cholesky refuses, gets a shift of the diagonal, so even
singular data go through.  The product R of the factors has A's singular
values and right vectors, and its singular value decomposition (on the driver,
d x d) gives the components: eigenvalue s * s / n for singular value s, so the
covariance is never squared into the result.

A pass is one scan of the fit list and a shuffle of d * d partial sums a task;
the driver sees d * d numbers.  Equal vectors are merged map-side before their
shuffle, so a vector that a third of the rows share costs one row a task.

Defined results: rows whose vector is null, holds null or non-finite entries
or entries of 2**56 or more in size (they have no exact long) are dropped, and
so are rows whose length is not the commonest of the fit list (ties: the
longer); repeated rows and null ids stay; components whose singular value is
under 1e-11 of the largest cannot be scaled and are left out, so constant data
or a single vector give no rows; ``deviation`` is null where the exact value
does not fit a long; a component's largest entry is positive; other columns
are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import prepare, stored

TOP = 16
STEP, OFFSET = 64, 1_000_000
#: Entries from this size on have no exact place on the lattice.
LARGEST = float(1 << 56)
#: Passes end when the Gram matrix is this near to the identity; orthogonal columns lose nothing more.
CLOSE = 1e-12
MOST_PASSES = 12
FLAT = 1e-11
_LONG = 1 << 62


@dataclass
class Whitening:
    n: int
    sums: list  # exact, for each dimension
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # (d, components)
    total: float  # trace of the covariance
    passes: int = 0
    identity_error: float = 0.0


def lattice(vector: str) -> Column:
    """The long x vector of a vector column; null where the row takes no part."""
    c = F.col(vector)
    whole = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < LARGEST))
    return F.when(whole, F.transform(c, lambda v: F.floor(F.lit(float(STEP)) * v.cast("double")) + F.lit(OFFSET).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _offsets(x: np.ndarray, n: int, sums: list) -> np.ndarray:
    """n * x - S, exact: longs, or Python whole numbers where longs are too short."""
    if n * int(np.abs(x).max(initial=0)) < _LONG:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q of Q R = A for an upper triangular R, column by column."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _sums(fit: DataFrame, d: int) -> tuple[int, list]:
    def add(batches):
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column("x"))
            if not len(x):
                continue
            part = x.sum(axis=0) if int(np.abs(x).max()) < 1 << 44 else x.astype(object).sum(axis=0)
            n, total = n + len(x), [a + int(b) for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "n", "s"])

    got = fit.mapInArrow(add, "i int, n bigint, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    return (int(got[0].n), [int(r.s) for r in got]) if got else (0, [0] * d)


def _gram(fit: DataFrame, n: int, sums: list, rows_of) -> tuple[np.ndarray, np.ndarray]:
    """Sum over the fit list of the outer products, and of the rows, of ``rows_of(centred rows)``."""

    def add(batches):
        total = None
        for batch in batches:
            x = _matrix(batch.column("x"))
            if len(x):
                q = rows_of(_offsets(x, n, sums).astype(np.float64) / n)
                q = np.concatenate([q, np.ones((len(q), 1))], axis=1)
                total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    got = fit.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    size = max(r.j for r in got) + 1
    out = np.zeros((size, size))
    for r in got:
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out[:-1, :-1], out[-1, :-1]


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.linalg.norm(gram, 2) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 1e-14 * np.linalg.norm(gram, 2), 1e-300)


def fit_list(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The distinct x vectors of the commonest length (a written table), and that length."""
    x = vectors.select(lattice(vector).alias("x")).where("x IS NOT NULL").distinct()
    x = stored(x, "white-fit")
    size = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = size.d if size else 0
    return x.where(F.size("x") == d), d


def fit(vectors: DataFrame, vector: str = "embedding", top: int = TOP) -> Whitening:
    """Components of the vectors' lattice covariance, the ``top`` first."""
    prepare(vectors.sparkSession)
    x, d = fit_list(vectors, vector)
    n, sums = _sums(x, d) if d else (0, [])
    nothing = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    if n < 2:
        return nothing
    factors: list[np.ndarray] = []

    def solved(a):
        for r in factors:
            a = _solve(a, r)
        return a

    whole = np.eye(d)
    for k in range(MOST_PASSES):
        gram, _ = _gram(x, n, sums, solved)
        if not gram.any():
            return nothing
        near, u = np.linalg.eigh(gram)
        if k + 1 == MOST_PASSES or k and np.all((np.abs(near - 1) <= CLOSE * d) | (near <= 1e-24)):
            whole = np.sqrt(np.maximum(near, 0))[:, None] * u.T @ whole  # all but orthogonal, and 0 where there is no spread
            break
        factors.append(_factor(gram, n, shifted=k == 0))
        whole = factors[-1] @ whole
    _, s, vt = np.linalg.svd(whole)
    keep = min(top, int((s > FLAT * s[0]).sum()))
    v = vt[:keep].T
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(keep)] < 0, -1.0, 1.0)
    out = Whitening(n, sums, s[:keep] ** 2 / n, v, float((s ** 2).sum() / n), len(factors))
    scale = v / np.sqrt(out.values)
    gram, total = _gram(x, n, sums, lambda a: a @ scale)
    out.identity_error = float(np.abs(gram / n - np.outer(total, total) / n ** 2 - np.eye(keep)).max())
    return out


def transform(vectors: DataFrame, model: Whitening, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    prepare(vectors.sparkSession)
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    keep, d, n, sums = len(model.values), len(model.sums), model.n, model.sums
    if not keep:
        return vectors.sparkSession.createDataFrame([], schema)
    v, root, explained, error = model.vectors, np.sqrt(model.values), model.values / model.total, model.identity_error

    def rate(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                apart = _offsets(_matrix(part.column("x")), n, sums)
                m = len(apart)
                if apart.dtype == object or float(np.abs(apart).max(initial=0)) ** 2 * d >= 2.0 ** 62:
                    apart = apart.astype(object)
                deviation = [int(t) if t < 1 << 63 else None for t in (apart * apart).sum(axis=1)] if apart.dtype == object else (apart * apart).sum(axis=1)
                white = (apart.astype(np.float64) / n) @ v / root
                row = np.repeat(np.arange(m), keep)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(row)), pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * keep, n, np.int64)), pa.array(deviation, pa.int64()).take(pa.array(row)), pa.array(white.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * keep, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = vectors.select(F.col(vec_id).alias("vec_id"), lattice(vector).alias("x")).where((F.col("x").isNotNull()) & (F.size("x") == d))
    return rows.mapInArrow(rate, schema)


def whiten(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", top: int = TOP) -> DataFrame:
    return transform(vectors, fit(vectors, vector, top), vector, vec_id)
