"""Collinearity screening by iterated variance inflation factors.

The reference fits p regressions per step, each over its own temporary copy
of the table. Here one aggregate pass yields the cross-product matrix of all
features over complete rows, and every VIF of a step follows from it on the
driver (one pivoted factorisation of a p x p matrix, which also tells dependent columns; a sweep
per feature only where a pivot lies near the tolerance). A dropped feature only forces a new pass
when it held NULLs, because only then can rows re-enter the complete set.

VIF of feature j: regress x_j on the other current features *without* an
intercept (the vector is passed as is), r2 = 1 - RSS/TSS with TSS centred,
vif = 1/(1-r2) = TSS/RSS; 1e100 for a perfect fit; skipped when TSS is 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.constants import VIF_THRESHOLD
from sparkprep.operators import linalg
from sparkprep.operators.gram import Moments, gram_stats, vector_elements
from sparkprep.operators.schema import feature_columns, qcol

STEP_SCHEMA = "step int, feature_w_max_vif string, vif double, discarded boolean"


@dataclass
class VifResult:
    steps: DataFrame
    kept_names: list[str]
    reduced: DataFrame | None = None
    history: list[tuple] = field(default_factory=list)


def _scores(m: Moments, idx: list[int], intercept: bool) -> dict[int, float]:
    """VIF per position of ``idx`` (a subset of the moments' columns)."""
    if m.n == 0 or len(idx) < 2:
        return {}
    sub = np.ix_(idx, idx)
    cp = (m.centred() if intercept else m.raw())[sub]
    tss = m.n * np.diag(m.cov)[idx]
    raw_diag = np.diag(m.raw())[idx]
    # constant features have no r2 and are never dropped, but explain the others
    varies = [pos for pos in range(len(idx))
              if np.isfinite(tss[pos]) and tss[pos] > linalg.PERFECT_FIT * raw_diag[pos]]
    rss = linalg.all_residuals(cp)
    out = {}
    for pos in varies:
        if rss is None:  # pivots near the tolerance: one sweep for each feature
            left = linalg.regress(cp, pos, [q for q in range(len(idx)) if q != pos])[1]
        else:
            left = rss[pos]
        out[idx[pos]] = (linalg.VIF_SENTINEL if left <= linalg.PERFECT_FIT * tss[pos]
                         else float(tss[pos] / left))
    return out


def _select(df: DataFrame, names: list[str], xs: list[Column], threshold: float,
            num_steps: int, intercept: bool, check: list[Column] | None = None,
            check_inputs: list[Column] | None = None):
    nulls = [F.sum(F.when(x.isNull(), 1).otherwise(0)).alias(f"_null{i}") for i, x in enumerate(
        [F.col(f"_x{i}") for i in range(len(xs))])]
    row = gram_stats(df, xs, extra_aggs=nulls + (check or []), extra_inputs=check_inputs).first().asDict()
    has_null = [(row[f"_null{i}"] or 0) > 0 for i in range(len(xs))]
    stats, stats_idx = Moments.of(row), list(range(len(xs)))
    current = list(range(len(xs)))
    steps = []
    step = 0
    while step < num_steps and len(current) >= 2:
        pos_of = {j: q for q, j in enumerate(stats_idx)}
        scores = _scores(stats, [pos_of[j] for j in current], intercept)
        if not scores:
            break
        best_j, best_v = None, None
        for j in current:  # ties go to the first feature in order
            v = scores.get(pos_of[j])
            if v is not None and (best_v is None or v > best_v):
                best_j, best_v = j, v
        steps.append((step, names[best_j], float(best_v), bool(best_v > threshold)))
        if best_v < threshold:
            break
        current.remove(best_j)
        if has_null[best_j]:
            sub = [xs[j] for j in current]
            stats, stats_idx = Moments.of(gram_stats(df, sub).first()), list(current)
        step += 1
    return steps, current, row


def vif_scores(df: DataFrame, features, names=None, intercept: bool = False) -> DataFrame:
    """``(feature, vif)`` for every feature of one step. ``features`` is a list
    of columns, or the name of an array column labelled by ``names`` (a list, or the
    name of a names-array column, which must be the same in all rows)."""
    check, inputs, column = [], [], None
    if isinstance(features, str) and isinstance(names, str):
        column = names
        first = df.select(qcol(names)).filter(F.col(qcol(names)).isNotNull()).head()
        names = list(first[0]) if first else []
        check = [F.min("_names").alias("_nmin"), F.max("_names").alias("_nmax")]
        inputs = [F.col(qcol(column)).alias("_names")]
    names, xs = _inputs(df, features, names)
    row = gram_stats(df, xs, extra_aggs=check, extra_inputs=inputs).first()
    if column and names and (list(row["_nmin"]) != names or list(row["_nmax"]) != names):
        raise ValueError(f"column {column} differs between rows")
    m = Moments.of(row)
    sc = _scores(m, list(range(len(xs))), intercept)
    rows = [(names[j], float(v)) for j, v in sorted(sc.items())]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def _inputs(df, features, names):
    if isinstance(features, str):
        if names is None:
            raise ValueError("names are required for an array column")
        return list(names), vector_elements(features, len(names))
    return list(features), [F.col(qcol(c)).cast("double") for c in features]


def vif_select_vectors(df: DataFrame, id_col: str, names_col: str, features_col: str,
                       threshold: float = VIF_THRESHOLD, num_steps: int = 20,
                       intercept: bool = False) -> VifResult:
    """Vector layout: every row must carry the same ``names`` array."""
    first = df.select(names_col).filter(F.col(names_col).isNotNull()).head()
    spark = df.sparkSession
    if first is None:
        return VifResult(spark.createDataFrame([], STEP_SCHEMA), [], df)
    names = list(first[0])
    xs = vector_elements(features_col, len(names))
    nm = F.col("_names")
    check = [F.min(nm).alias("_nmin"), F.max(nm).alias("_nmax")]
    steps, kept, row = _select(df, names, xs, threshold, num_steps, intercept, check,
                               [F.col(qcol(names_col)).alias("_names")])
    if list(row["_nmin"] or []) != names or list(row["_nmax"] or []) != names:
        raise ValueError(f"column {names_col} differs between rows")
    reduced = df.select(
        F.col(qcol(id_col)),
        F.array(*[F.lit(names[j]) for j in kept]).alias(names_col),
        F.array(*[F.get(F.col(qcol(features_col)), j) for j in kept]).alias(features_col))
    return VifResult(spark.createDataFrame(steps, STEP_SCHEMA), [names[j] for j in kept],
                     reduced, steps)


def vif_select_columns(df: DataFrame, id_col: str, label_col: str | None = None,
                       exclude=(), threshold: float = VIF_THRESHOLD, num_steps: int = 10,
                       intercept: bool = False) -> VifResult:
    """Wide layout: features are the numeric columns in schema order, minus
    ``exclude``, the id and the label."""
    drop = set(exclude or ()) | {id_col} | ({label_col} if label_col else set())
    names = feature_columns(df, drop, order="ordinal")
    xs = [F.col(qcol(c)).cast("double") for c in names]
    steps, kept, _ = _select(df, names, xs, threshold, num_steps, intercept)
    keep_cols = [id_col] + [names[j] for j in kept] + ([label_col] if label_col else [])
    return VifResult(df.sparkSession.createDataFrame(steps, STEP_SCHEMA),
                     [names[j] for j in kept], df.select(*[qcol(c) for c in keep_cols]), steps)
