"""Embedding whitening with eigenvectors refined to double precision.

The covariance of the different vectors is added up by Spark, centred before multiplying. Its eigenvectors are found in
float32 first and then corrected by the matrix-multiplication iterations of Ogita and Aishima in higher precision: each
measures how far the vectors are from orthonormal and from diagonalizing the matrix and takes that out at once, so that
the number of right digits doubles. Where eigenvalues are too close to be told apart at the precision reached, the
cluster's small problem is solved by itself within its subspace. Only the sums and the covariance, dimension squared
numbers whatever the number of vectors, come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameyard.llm.common import materialize, release

COMPONENTS, STEPS = 4, 256
#: Components below this share of the variance are noise of the arithmetic, not directions of the vectors.
NOISE = 1e-12
#: Steps that bring no progress before the refinement ends.
PATIENCE = 3
#: Exact integers of this size fit into 64 bits.
EXACT = 2**63


def _slices(a: np.ndarray) -> list[np.ndarray]:
    """Three float64 matrices that add up to the extended-precision a, rows so few bits wide that products are exact."""
    bits = (53 - int(np.ceil(np.log2(max(2, a.shape[1]))))) // 2
    out = []
    for _ in range(3):
        peak = np.abs(a).max(axis=1, keepdims=True)
        unit = np.ldexp(np.longdouble(1), np.frexp(peak)[1] - bits)
        out.append((np.rint(a / unit) * unit).astype("f8"))
        a = a - out[-1]
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in extended precision by double-precision products of slices, each without rounding."""
    left, right = _slices(a), [x.T for x in _slices(b.T)]
    total = np.zeros((a.shape[0], b.shape[1]), np.longdouble)
    for order in (2, 1, 0):
        for i in range(order + 1):
            total += left[i] @ right[order - i]
    return total


def refine_eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the symmetric matrix a, falling, and unit eigenvectors in columns, right to double precision; of
    equal eigenvalues any orthonormal vectors of their space. The greatest entry of each vector is positive."""
    scale = np.abs(a).max(initial=0) or 1.0
    a = np.asarray(a, np.longdouble) / scale
    x = np.linalg.eigh(a.astype("f4"))[1].astype(np.longdouble)
    best, kept, idle = np.inf, x, 0
    while True:
        r = np.eye(len(a)) - _product(x.T, x)
        s = _product(x.T, _product(a, x))
        e = np.diag(s) / (1 - np.diag(r))
        s = s - np.diag(np.diag(s))
        # how far x is from orthonormal and from diagonalizing a; clusters may set it back for a step
        size = float(max(np.abs(s).max(initial=0), np.abs(r).max(initial=0)))
        idle = 0 if size < best / 2 else idle + 1
        if size < best:
            best, kept = size, x
        if idle > PATIENCE or not size:
            break
        reach = 2 * (np.linalg.norm(s.astype("f8"), 2) + np.linalg.norm(a.astype("f8"), 2) * np.linalg.norm(r.astype("f8"), 2))
        gap = e[None, :] - e[:, None]
        far = np.abs(gap) > reach
        x = x + _product(x, np.where(far, (s + e[None, :] * r) / np.where(far, gap, 1), r / 2))
        # the clusters' own small problems: shifted, so that the digits in which they differ are kept
        order = np.argsort(-e, kind="stable")
        x, e = x[:, order], e[order]
        cuts = np.flatnonzero(np.append(-np.diff(e) > reach, True)) + 1
        for lo, hi in zip(np.concatenate([[0], cuts[:-1]]), cuts, strict=True):
            if hi - lo > 1:
                v = x[:, lo:hi]
                t = _product(v.T, _product(a, v) - v * e[lo:hi].mean())
                if peak := float(np.abs(t).max()):
                    x[:, lo:hi] = _product(v, np.linalg.eigh((t / peak).astype("f8"))[1][:, ::-1].astype(np.longdouble))
    x = kept
    x = x / np.sqrt((x * x).sum(0))
    e = (x * _product(a, x)).sum(0)
    order = np.argsort(-e, kind="stable")
    x, e = x[:, order], e[order] * scale
    return e.astype("f8"), (x * np.where(x[np.abs(x).argmax(0), np.arange(x.shape[1])] < 0, -1, 1)).astype("f8")


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _sums(fit: DataFrame, dim: int) -> list[int]:
    """The exact sum of each dimension. Halves of 32 bits are added up, so that no batch overflows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            total = [t + (int(h) << 32) + int(lo) for t, h, lo in zip(total, (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))], ["j", "s"])

    got = fit.select("x").mapInArrow(add, "j int, s decimal(38,0)").groupBy("j").agg(F.sum("s").alias("s")).collect()
    out = [0] * dim
    for r in got:
        out[r["j"]] = int(r["s"])
    return out


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, from exact integers where they fit and in double precision else."""
    if n * (int(np.abs(x.astype("f8")).max(initial=0)) + 1) < EXACT and max(map(abs, sums), default=0) < EXACT // 2:
        return (n * x - np.array(sums, "i8")) / n
    return x - np.array([s / n for s in sums])


def _moments(fit: DataFrame, dim: int, project) -> np.ndarray:
    """Mean of y y^T over the fit list, y = project(x) of width dim; one dim x dim table a task, which Spark adds up."""
    i, j = np.triu_indices(dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((dim, dim)), 0
        for batch in batches:
            y = project(batch.column(0))
            total, rows = total + y.T @ y, rows + len(y)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    out = np.zeros((dim, dim))
    for r in fit.select("x").mapInArrow(add, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return out


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """sum((n * x - sums) ** 2) of each row, exact; None beyond 64 bits."""
    far = n * (int(np.abs(x.astype("f8")).max(initial=0)) + 1) + max(map(abs, sums), default=0)
    if len(sums) * far * far < EXACT:
        return ((n * x - np.array(sums, "i8")) ** 2).sum(1).tolist()
    exact = (sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x)
    return [d if d < EXACT else None for d in exact]


def whiten(vectors: DataFrame, components: int = COMPONENTS, steps: int = STEPS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Whitened coordinates of every vector: one row per vector and component, components numbered from 1.

    Entries are rounded down to 1 / steps first; the fit is over the different rounded vectors, so that copies count
    once. Dropped are null vectors and those with null or non-finite entries, and vectors of another length than most
    different ones have (ties: the longer). Components without variance are not returned: at most as many as the fit
    list has directions, none for a single vector or none at all. Entries beyond 64 bits are held at their ends;
    `deviation` is null where its exact value does not fit into 64 bits. Repeated rows and null ids have rows of their
    own. Other columns are not read.
    """
    entry = lambda c: c.cast("double")
    ok = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < float("inf")))
    x = F.transform(vector_col, lambda c: F.floor(entry(c) * F.lit(float(steps))))
    rows = vectors.where(F.col(vector_col).isNotNull() & ok).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    fit = materialize(rows.select("x").distinct())
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    most = fit.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not most or not most[0]["dim"]:
        return rows.sparkSession.createDataFrame([], schema)
    dim, n = most[0]["dim"], most[0]["n"]
    whole = F.size("x") == dim
    sums = _sums(fit.where(whole), dim)
    v = _moments(fit.where(whole), dim, lambda column: _centred(_matrix(column, dim), n, sums)) / n
    e, u = refine_eigenvectors(v)
    k = min(components, int((e > NOISE * max(np.trace(v), 0)).sum()))
    turn, explained = u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(v) if k else e[:k]
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    project = lambda column: _centred(_matrix(column, dim), n, sums) @ turn
    error = float(np.abs(_moments(fit.where(whole), k, project) / n - np.eye(k)).max())
    release(fit)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            each = np.repeat(np.arange(m), k)
            deviation = pa.array(_deviation(_matrix(batch.column(1), dim), n, sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), m)), pa.array(np.full(m * k, n)),
                    deviation.take(pa.array(each)), pa.array(project(batch.column(1)).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.where(whole).mapInArrow(apply, schema)
