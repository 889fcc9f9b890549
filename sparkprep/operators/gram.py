"""Sufficient statistics of a design matrix: n, means and population
covariances over complete rows, optionally per group.

One aggregate pass. ``covar_pop`` / ``var_pop`` are Spark's single-pass
co-moment aggregates (numerically stable, mergeable), so the job is a map-side
partial aggregate plus one small exchange; a hot group is pre-aggregated in
every task before the shuffle. Raw cross products ``X^T X`` and centred ones
are both derived from these on the driver or in a per-group solve.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.operators.schema import qcol


def vector_elements(features: str, p: int) -> list[Column]:
    """The ``p`` elements of an array column; all NULL for a NULL vector, an error for a
    vector of another length (checked with the first element, in the same pass)."""
    x = F.col(qcol(features))
    xs = [F.get(x, i).cast("double") for i in range(p)]
    if xs:
        wrong = F.raise_error(F.lit(f"feature vectors must all have {p} elements")).cast("double")
        xs[0] = F.when(x.isNotNull() & (F.size(x) != p), wrong).otherwise(xs[0])
    return xs


def complete(xs: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.isNotNull() for x in xs])


def moment_columns(xs: list[Column], n: Column) -> list[Column]:
    """``n``, ``means`` (array) and ``cov`` (row-major p*p array) aggregates."""
    p = len(xs)
    cells = {}
    for i in range(p):
        for j in range(i, p):
            cells[(i, j)] = (F.var_pop(xs[i]) if i == j else F.covar_pop(xs[i], xs[j]))
    aggs = [n.alias("n"), F.array(*[F.avg(x) for x in xs]).cast("array<double>").alias("means")]
    flat = [cells[(min(i, j), max(i, j))] for i in range(p) for j in range(p)]
    aggs.append(F.array(*flat).cast("array<double>").alias("cov"))
    return aggs


def gram_stats(df: DataFrame, xs: list[Column], by: list[str] | None = None,
               extra_aggs: list[Column] | None = None,
               extra_inputs: list[Column] | None = None) -> DataFrame:
    """One row per group: ``by..., n, means, cov``. Rows with a NULL in any of
    ``xs`` are masked out of the moments (``n`` counts complete rows only);
    ``extra_aggs`` (over ``_x{i}`` raw columns and ``extra_inputs``) see all
    rows. Without ``by`` the result has exactly one row."""
    by = by or []
    named = [x.alias(f"_x{i}") for i, x in enumerate(xs)]
    mask = [complete(xs).alias("_ok")] if xs else []
    base = df.select(*[F.col(qcol(b)) for b in by], *named, *mask, *(extra_inputs or []))
    raw = [F.col(f"_x{i}") for i in range(len(xs))]
    if raw:
        ok = F.col("_ok")
        masked = [F.when(ok, x) for x in raw]
        aggs = moment_columns(masked, F.count(F.when(ok, F.lit(1))))
    else:
        aggs = moment_columns([], F.count(F.lit(1)))
    aggs += list(extra_aggs or [])
    if len(xs) > WIDE_P:
        return _wide_stats(base, len(xs), by, list(extra_aggs or []))
    if by:
        return base.groupBy(*[F.col(qcol(b)) for b in by]).agg(*aggs)
    return base.agg(*aggs)


# Above this many variables the p(p+1)/2 covariance aggregates no longer fit generated
# code (JVM method limits), so NumPy keeps the same moments; rows and values agree.
WIDE_P = 40
# Doubles of group moments that a task holds before it passes them on.
HELD_DOUBLES = 8_000_000
# Tasks whose moments meet first, before those sums meet per group.
FAN_IN = 256


def _combine(a: tuple, b: tuple) -> tuple:
    """Moments (n, mean, centred products) of two parts together."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n = a[0] + b[0]
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def _wide_stats(base: DataFrame, p: int, by: list[str], extra_aggs: list[Column]) -> DataFrame:
    """Same rows as the aggregates. Every task sums up its rows per group with NumPy;
    partial moments meet in two levels (``FAN_IN`` tasks, then the group), streamed in
    group order, so neither a hot group nor many tasks gather in memory. Groups
    are those of Spark's grouping, NULL keys and groups without a complete row included."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    from sparkprep.session import ship_package
    ship_package(base.sparkSession)
    keys = [f"_k{i}" for i in range(len(by))]
    key_cols = [F.col(qcol(b)).alias(k) for b, k in zip(by, keys)]
    x = F.when(F.col("_ok"), F.array(*[F.col(f"_x{i}") for i in range(p)]))
    rows = base.select(*key_cols, x.alias("_v"), F.floor(F.spark_partition_id() / FAN_IN).cast("int")
                       .alias("_part"))
    vector = T.ArrayType(T.DoubleType())
    schema = T.StructType([*[T.StructField(k, rows.schema[k].dataType) for k in keys],
                           T.StructField("_part", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("means", vector), T.StructField("m2", vector)])
    kinds = {f.name: to_arrow_type(f.dataType) for f in schema}
    most = max(1, HELD_DOUBLES // (p * (p + 1)))

    def given(found: list[tuple], part: int) -> pa.RecordBatch:
        columns = [[g[0][i] for g in found] for i in range(len(keys))]
        columns += [[part] * len(found), [m[0] for _, m in found], [m[1].tolist() for _, m in found],
                    [m[2].ravel().tolist() for _, m in found]]
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(columns, kinds)],
                                          names=list(kinds))

    def partial(batches):
        held: dict = {}
        part = 0
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column("_part")[0].as_py()
            inverse, firsts = _groups_of([b.column(k) for k in keys], b.num_rows)
            ok = b.column("_v").is_valid().to_numpy(zero_copy_only=False)
            x = np.zeros((b.num_rows, p))
            x[ok] = b.column("_v").filter(pa.array(ok)).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            order = np.argsort(inverse, kind="stable")
            bounds = np.searchsorted(inverse[order], np.arange(len(firsts) + 1))
            for g, at in enumerate(firsts):
                key = tuple(b.column(k)[int(at)].as_py() for k in keys)
                here = order[bounds[g]:bounds[g + 1]]
                v = x[here[ok[here]]]
                mean = v.mean(axis=0) if len(v) else np.zeros(p)
                d = v - mean
                new = (len(v), mean, d.T @ d)
                slot = repr(key)
                held[slot] = (key, _combine(held[slot][1], new) if slot in held else new)
                if len(held) >= most:
                    yield given(list(held.values()), part)
                    held = {}
        if held:
            yield given(list(held.values()), part)

    def merge(batches):
        last = None
        for b in batches:
            n, means = b.column("n").to_pylist(), b.column("means").flatten().to_numpy().reshape(-1, p)
            m2 = b.column("m2").flatten().to_numpy().reshape(-1, p, p)
            parts = b.column("_part").to_pylist()
            done = []
            for r in range(b.num_rows):
                key = tuple(b.column(k)[r].as_py() for k in keys)
                new, slot = (n[r], means[r], m2[r]), (parts[r], repr(key))
                if last is not None and last[0] == slot:
                    last = (slot, key, _combine(last[2], new))
                else:
                    if last is not None:
                        done.append(last)
                    last = (slot, key, new)
            for slot, key, m in done:
                yield given([(key, m)], slot[0])
        if last is not None:
            yield given([(last[1], last[2])], last[0][0])

    def met(df: DataFrame) -> DataFrame:
        together = [*keys, "_part"]
        return df.repartition(*together).sortWithinPartitions(*together).mapInArrow(merge, schema)

    whole = met(met(rows.mapInArrow(partial, schema)).withColumn("_part", F.lit(0)))
    n = F.col("n")
    st = whole.select(*keys, "n", F.when(n > 0, F.col("means")).otherwise(F.array_repeat(
        F.lit(None).cast("double"), p)).alias("means"), F.when(n > 0, F.transform("m2", lambda c: c / n))
        .otherwise(F.array_repeat(F.lit(None).cast("double"), p * p)).alias("cov"))
    if not by:  # an empty input has its row, too
        one = (base.agg(F.count(F.lit(1)).alias("_rows"), *extra_aggs) if extra_aggs
               else base.sparkSession.range(1).select(F.lit(0).alias("_rows")))
        st = one.withColumn("_one", F.lit(1)).join(st.withColumn("_one", F.lit(1)), "_one", "left")
        null = F.lit(None).cast("double")
        return st.select(F.coalesce("n", F.lit(0).cast("long")).alias("n"),
                         F.coalesce("means", F.array_repeat(null, p)).alias("means"),
                         F.coalesce("cov", F.array_repeat(null, p * p)).alias("cov"),
                         *[c for c in one.columns if c != "_rows"])
    if extra_aggs:  # one row per group on both sides
        extra = base.groupBy(*[F.col(qcol(b)).alias(f"_e{i}") for i, b in enumerate(by)]).agg(*extra_aggs)
        same = reduce(lambda a, c: a & c, [F.col(k).eqNullSafe(F.col(f"_e{i}")) for i, k in enumerate(keys)])
        st = st.join(extra, same).drop(*[f"_e{i}" for i in range(len(by))])
    return st.withColumnsRenamed(dict(zip(keys, by)))


def _groups_of(columns: list, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The group number of every row of a batch, and the first row of each group."""
    codes = np.zeros(rows, dtype=np.int64)
    for c in columns:
        try:
            code = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        except NotImplementedError:  # pyarrow has no dictionary of nested keys
            code = np.unique([repr(v) for v in c.to_pylist()], return_inverse=True)[1]
        codes = np.unique(codes * (int(code.max()) + 1) + code, return_inverse=True)[1]
    _, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
    return inverse, first


class Moments:
    """Driver-side view of one group's statistics."""

    def __init__(self, n: int, means, cov):
        self.n = int(n)
        p = len(means)
        self.means = np.array([np.nan if m is None else m for m in means], dtype=np.float64)
        self.cov = (np.array([np.nan if c is None else c for c in cov], dtype=np.float64)
                    .reshape(p, p) if p else np.zeros((0, 0)))

    @classmethod
    def of(cls, row) -> "Moments":
        """From a statistics row (Row or dict with ``n``, ``means``, ``cov``)."""
        return cls(row["n"], row["means"], row["cov"])

    def raw(self) -> np.ndarray:
        """X^T X."""
        return self.n * (self.cov + np.outer(self.means, self.means))

    def centred(self) -> np.ndarray:
        return self.n * self.cov

    def sums(self) -> np.ndarray:
        return self.n * self.means


def gram_matrix(df: DataFrame, features, target_col: str | None = None, p: int | None = None,
                by: list[str] | None = None) -> DataFrame:
    """Long ``(by..., i, j, n, sum_i, xtx)`` table of raw cross products over
    complete rows; ``features`` is a list of column names or an array column
    (then ``p`` is its length, read from the first row when not given). A
    ``target_col`` joins as the last variable, giving ``X^T y`` and ``y^T y``.
    Indices are 1-based."""
    by = by or []
    if isinstance(features, str):
        if p is None:
            first = df.select(F.size(qcol(features)).alias("s")).filter("s >= 0").head()
            p = int(first[0]) if first else 0
        xs = vector_elements(features, p)
    else:
        xs = [F.col(qcol(c)).cast("double") for c in features]
    if target_col is not None:
        xs = xs + [F.col(qcol(target_col)).cast("double")]
    p = len(xs)
    st = gram_stats(df, xs, by)
    keys = [F.col(qcol(b)) for b in by]
    # one row per cell of cov, rather than p * p expressions in the plan
    cells = st.select(*keys, "n", "means", F.posexplode("cov").alias("_at", "_cov"))
    i, j = F.floor(F.col("_at") / p).cast("int"), F.col("_at") % p
    n, mean_i, mean_j = F.col("n"), F.get("means", i), F.get("means", j)
    return cells.select(*keys, (i + 1).cast("long").alias("i"), (j + 1).cast("long").alias("j"),
                        n.cast("long").alias("n"), (n * mean_i).alias("sum_i"),
                        (n * (F.col("_cov") + mean_i * mean_j)).alias("xtx"))
