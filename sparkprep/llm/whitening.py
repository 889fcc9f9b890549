"""Whitening of embeddings by an incremental eigendecomposition.

A vector c becomes the whole numbers x = floor(256 c); the fit list holds each distinct x once.
The eigenpairs of its covariance come in four distributed steps:

1. every partition of the fit list keeps a spectrum (eigenvalues and orthonormal eigenvectors of
   the scatter of the rows seen so far) and applies centred rank-one updates to it. A rank-one
   update rotates equal eigenvalues together and sets aside those the new direction does not touch
   (deflation), solves the secular equation for the others inside the intervals that the old
   eigenvalues bound, and gets their vectors from recomputed weights, which keeps them orthogonal.
   Rows come in blocks; a block is centred and reduced to the at most d rows with the same scatter
   (the triangular factor of its QR decomposition), so a block of B rows costs min(B, d) updates
   and one for the move of the mean;
2. spectra are combined by successive rank-one updates with the other's scaled eigenvectors and the
   difference of the means, in a tree of ``FAN`` per task and level, in the order of partitions;
3. one Rayleigh-Ritz pass over the fit list: rows, centred exactly in whole numbers, are projected
   on the combined (re-orthogonalised) basis, the d by d products are summed in the same tree, and
   the eigenvectors of that sum turn the basis into the final components. Rounding
   of the updates is thereby gone: the components are those of the exact covariance;
4. one pass measures the covariance of the whitened fit list.

The driver holds one d by d basis, the d sums and the eigenvalues, never rows; tasks get the same
with their closure (8 d^2 bytes: 32 KB for 64 dimensions). The table of partial spectra has one row
for each partition and is written to the shared folder level by level.

Defined results: vectors that are null, empty or hold null or non-finite entries are dropped; d is
the most frequent length (the greater of two) and vectors of other lengths are dropped too; repeated
rows each get their result, whatever their ids, null ids included; an empty table gives an empty
result; entries outside the range of a long are clamped to it; a deviation beyond a long is null;
a component without variance has ``whitened`` null and is left out of ``identity_error``; without
any variance ``explained`` is null and ``identity_error`` 0. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import of, written
from sparkprep.session import ship_package

SCALE = 256
#: Rows reduced together before their updates; partial results combined by one task.
BLOCK, FAN = 4096, 16
EPS = float(np.finfo(np.float64).eps)


# ------------------------------------------------------------------ rank-one updates
def _secular(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z_j^2 / (d_j - t)), one above each d (ascending, distinct; z not 0).

    Returns the index of the nearer pole of each root and the root's distance from it: the
    difference to a pole is then exact however close the two are. Steps use the rational function
    with the interval's two poles that has the same value and slopes; a step that would
    leave the bracket is a bisection.
    """
    k, zz = len(d), z * z
    rho = float(zz.sum())
    gap = np.append(np.diff(d), rho)
    middle = 1.0 + (zz / ((d[None, :] - d[:, None]) - gap[:, None] / 2)).sum(axis=1)
    right = (middle < 0) & (np.arange(k) < k - 1)
    origin = np.arange(k) + right
    lo = np.where(right, -gap / 2, 0.0)
    hi = np.where(right, 0.0, gap / 2)
    hi[-1], lo[-1] = (rho, gap[-1] / 2) if middle[-1] < 0 else (gap[-1] / 2, 0.0)
    mu = (lo + hi) / 2
    at = np.arange(k)
    for _ in range(90):
        delta = d[None, :] - d[origin[at]][:, None] - mu[at][:, None]
        part = zz / delta
        slope = part / delta
        f = 1.0 + part.sum(axis=1)
        last = at == k - 1
        left = np.arange(k)[None, :] <= (at - last)[:, None]
        psi, phi = np.where(left, slope, 0.0).sum(axis=1), np.where(left, 0.0, slope).sum(axis=1)
        hi[at] = np.where(f > 0, mu[at], hi[at])
        lo[at] = np.where(f > 0, lo[at], mu[at])
        i = np.arange(len(at))
        one, two = delta[i, np.maximum(at - last, 0)], delta[i, np.minimum(at + 1, k - 1)]
        with np.errstate(all="ignore"):
            c = f - one * psi - two * phi
            a = (one + two) * f - one * two * (psi + phi)
            b = one * two * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            root = np.where(last, -root, root)  # above the last pole it is the other solution
            step = mu[at] + np.where((a <= 0) ^ last, (a - root) / (2 * c), 2 * b / (a + root))
        inside = np.isfinite(step) & (step > lo[at]) & (step < hi[at])
        new = np.where(inside, step, (lo[at] + hi[at]) / 2)
        exact = np.abs(f) <= 4 * EPS * (1.0 + np.abs(part).sum(axis=1))
        size = 2 * EPS * np.maximum(np.abs(lo[at]), np.abs(hi[at]))
        open_ = ~exact & (np.abs(new - mu[at]) > 2 * EPS * np.abs(new)) & (hi[at] - lo[at] > size)
        mu[at] = np.where(exact, mu[at], new)
        at = at[open_]
        if not len(at):
            break
    return origin, mu


def rank_one(lam: np.ndarray, vec: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors (columns) of vec diag(lam) vec' + v v'."""
    z = vec.T @ v
    rho = float(z @ z)
    if not rho > 0:
        return lam, vec
    lam, vec = lam.copy(), vec.copy()
    tol = 8 * EPS * max(float(lam[-1]), rho)
    for i in np.flatnonzero(np.diff(lam) <= tol):  # equal eigenvalues: one of them takes all
        r = float(np.hypot(z[i], z[i + 1]))
        if r > 0:
            c, s = z[i + 1] / r, z[i] / r
            vec[:, i], vec[:, i + 1] = c * vec[:, i] - s * vec[:, i + 1], s * vec[:, i] + c * vec[:, i + 1]
            z[i], z[i + 1] = 0.0, r
    keep = np.flatnonzero(np.abs(z) * np.sqrt(rho) > tol)
    if len(keep):
        d = lam[keep]
        origin, mu = _secular(d, z[keep])
        away = (d[origin][:, None] - d[None, :]) + mu[:, None]  # root i minus old eigenvalue j
        poles = d[:, None] - d[None, :]
        np.fill_diagonal(poles, 1.0)
        weight = np.sqrt(np.abs(np.prod(away / poles, axis=0)))
        rot = np.copysign(weight, z[keep])[None, :] / -away
        rot /= np.linalg.norm(rot, axis=1, keepdims=True)
        vec[:, keep] = vec[:, keep] @ rot.T
        lam[keep] = d[origin] + mu
    order = np.argsort(lam, kind="stable")
    return lam[order], vec[:, order]


@dataclass
class Spectrum:
    """Eigenpairs of the scatter of ``n`` rows around their mean, and the rows' exact sums."""
    n: int
    sums: list[int]
    mean: np.ndarray
    lam: np.ndarray
    vec: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, [0] * d, np.zeros(d), np.zeros(d), np.eye(d))

    def _moved(self, n: int, mean: np.ndarray) -> None:
        if self.n:
            shift = (mean - self.mean) * np.sqrt(self.n * n / (self.n + n))
            self.lam, self.vec = rank_one(self.lam, self.vec, shift)
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add_rows(self, x: np.ndarray) -> None:
        """Whole-number rows (n, d), reduced to rows of the same scatter first."""
        if not len(x):
            return
        sums = _exact_sums(x)
        mean = np.array([s / len(x) for s in sums])
        centred = x.astype(np.float64) - mean
        for row in np.linalg.qr(centred, mode="r"):
            self.lam, self.vec = rank_one(self.lam, self.vec, row)
        self._moved(len(x), mean)
        self.sums = [a + b for a, b in zip(self.sums, sums)]

    def add(self, other: Spectrum) -> None:
        for lam, v in zip(other.lam, other.vec.T):
            if lam > 0:
                self.lam, self.vec = rank_one(self.lam, self.vec, np.sqrt(lam) * v)
        if other.n:
            self._moved(other.n, other.mean)
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]


def _fits(x: np.ndarray, times: int) -> bool:
    """Whether sums of ``times`` such values stay in a long."""
    return not x.size or max(int(x.max()), -int(x.min())) * max(times, 1) < 1 << 62


def _exact_sums(x: np.ndarray) -> list[int]:
    if _fits(x, len(x)):
        return [int(v) for v in x.sum(axis=0)]
    return [sum(col) for col in x.T.tolist()]


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs where they fit, else Python's integers."""
    s = max(map(abs, sums), default=0)
    if _fits(x, 2 * n) and s < 1 << 61:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _deviations(scaled: np.ndarray) -> list[int | None]:
    if scaled.dtype != object:
        most = max(int(scaled.max()), -int(scaled.min())) if scaled.size else 0
        if most * most * scaled.shape[1] < 1 << 63:
            return (scaled * scaled).sum(axis=1).tolist()
    total = ((sum(v * v for v in row)) for row in scaled.tolist())
    return [t if t < 1 << 63 else None for t in total]


# ------------------------------------------------------------------ distributed passes
SPECTRA = T.StructType([T.StructField("pid", T.LongType()), T.StructField("n", T.LongType()),
                        T.StructField("sums", T.ArrayType(T.StringType())),
                        *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("mean", "lam", "vec")]])
SUMS = T.StructType([T.StructField("pid", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType()))])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _row(s: Spectrum, pid: int) -> dict:
    return {"pid": pid, "n": s.n, "sums": [str(v) for v in s.sums], "mean": s.mean.tolist(),
            "lam": s.lam.tolist(), "vec": s.vec.ravel().tolist()}


def _spectrum(row: dict) -> Spectrum:
    d = len(row["mean"])
    return Spectrum(row["n"], [int(v) for v in row["sums"]], np.array(row["mean"]), np.array(row["lam"]),
                    np.array(row["vec"]).reshape(d, d))


def combined(partials: DataFrame, merge: Callable[[list[dict]], dict], label: str) -> dict | None:
    """One row out of one per partition: up to ``FAN`` rows meet in a task, level after level."""
    schema = partials.schema
    arrow = _arrow(schema)

    def meet(group: pa.Table) -> pa.Table:
        rows = sorted(group.drop_columns("unit").to_pylist(), key=lambda r: r["pid"])
        return pa.Table.from_pylist([merge(rows) | {"pid": rows[0]["pid"] // FAN}], schema=arrow)

    while True:
        partials = written(partials, label)
        top = partials.agg(F.max("pid")).first()[0]
        if not top:
            row = partials.first()
            return row.asDict() if row else None
        unit = F.floor(F.col("pid") / F.lit(FAN)).alias("unit")
        partials = partials.withColumn("unit", unit).groupBy("unit").applyInArrow(meet, schema)


def _merged(rows: list[dict]) -> dict:
    first = _spectrum(rows[0])
    for r in rows[1:]:
        first.add(_spectrum(r))
    return _row(first, rows[0]["pid"])


def _added(rows: list[dict]) -> dict:
    return {"v": np.sum([r["v"] for r in rows], axis=0).tolist()}


def _summed(fit: DataFrame, d: int, terms: Callable[[np.ndarray], np.ndarray], label: str) -> np.ndarray:
    """The sum of ``terms`` (of a block of rows) over the fit list."""
    arrow = _arrow(SUMS)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                here = terms(_matrix(b, d)).ravel()
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_pylist([{"pid": TaskContext.get().partitionId(), "v": total.tolist()}],
                                             schema=arrow)

    return np.array(combined(fit.mapInArrow(partial, SUMS), _added, label)["v"])


@dataclass
class Fit:
    """Components (columns) by falling eigenvalue, with what whitening needs of the fit list."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def whitened(self, scaled: np.ndarray) -> np.ndarray:
        y = (scaled / self.n).astype(np.float64) @ self.vectors
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, y / np.sqrt(self.values), np.nan)


def rows_of(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, x) of the usable vectors, and their dimension (0: there are none)."""
    v = of(df, vector_col)
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    rows = df.where(usable).select(of(df, id_col).alias("id"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return (rows.where(F.size("x") == most["d"]), most["d"]) if most else (rows, 0)


def fitted(rows: DataFrame, d: int, components: int, block: int = BLOCK) -> Fit:
    """The decomposition of the distinct vectors of ``rows`` (id, x)."""
    fit = written(rows.select("x").distinct(), "whitening-fit")
    arrow = _arrow(SPECTRA)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = Spectrum.empty(d), [], 0
        for b in batches:
            held.append(_matrix(b, d))
            size += len(held[-1])
            if size >= block:
                own.add_rows(np.concatenate(held))
                held, size = [], 0
        if held:
            own.add_rows(np.concatenate(held))
        if own.n:
            yield pa.RecordBatch.from_pylist([_row(own, TaskContext.get().partitionId())], schema=arrow)

    one = _spectrum(combined(fit.mapInArrow(partial, SPECTRA), _merged, "whitening-spectra"))
    n, sums = one.n, one.sums
    basis = np.linalg.qr(one.vec[:, ::-1])[0]

    def products(x: np.ndarray) -> np.ndarray:
        y = (_scaled(x, n, sums) / n).astype(np.float64) @ basis
        return y.T @ y

    ritz = _summed(fit, d, products, "whitening-ritz").reshape(d, d) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    trace = float(np.trace(ritz))
    k = min(components, d)
    values, vectors = values[::-1][:k].copy(), (basis @ turn[:, ::-1])[:, :k].copy()
    values[values <= d * EPS * max(trace, 0.0)] = 0.0
    found = Fit(n, sums, values, vectors, trace, 0.0)
    live = int((values > 0).sum())
    if live:
        def squares(x: np.ndarray) -> np.ndarray:
            w = found.whitened(_scaled(x, n, sums))[:, :live]
            return np.concatenate([w.sum(axis=0)[None, :], w.T @ w])

        sums_of = _summed(fit, d, squares, "whitening-check").reshape(live + 1, live) / n
        found.identity_error = float(np.abs(sums_of[1:] - np.outer(sums_of[0], sums_of[0]) - np.eye(live)).max())
    return found


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """For every usable vector and component: id, component, n, deviation, whitened, explained and
    identity_error."""
    spark = df.sparkSession
    ship_package(spark)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType),
                           T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained",
                                                                       "identity_error")]])
    rows, d = rows_of(df, id_col, vector_col)
    if not d:
        return spark.createDataFrame([], schema)
    fit = fitted(rows, d, components)
    arrow = _arrow(schema)
    k = len(fit.values)
    explained = [float(e) / fit.trace if fit.trace > 0 else None for e in fit.values]

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            scaled = _scaled(_matrix(b, d), fit.n, fit.sums)
            size, values = b.num_rows, fit.whitened(scaled).ravel()
            each = np.repeat(np.arange(size), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").cast(arrow.field(0).type).take(pa.array(each)),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                 pa.array(np.full(size * k, fit.n, np.int64)),
                 pa.array(_deviations(scaled), pa.int64()).take(pa.array(each)),
                 pa.array(values, mask=np.isnan(values)), pa.array(explained * size, pa.float64()),
                 pa.array(np.full(size * k, fit.identity_error))], schema=arrow)

    return rows.mapInArrow(project, schema)
