"""Row- and group-level array operators.

Row operators are projections (codegen'd built-ins). Group operators never
build an array they do not return: sizes come from ``sum(size(arr))``
(partial aggregation), running totals from a window sum over sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.constants import (ACCUMULATE_DONE_PREFIX, ACCUMULATE_DONE_SUFFIX,
                                 ACCUMULATE_PENDING, BYTES_PER_VALUE, GROUP_SIZE_PREFIX)
from sparkprep.functions.arrays import filter_array_at_index
from sparkprep.operators.schema import qcol


def _size0(a):
    """Element count, 0 for a NULL array (``size(NULL)`` is -1 without ANSI mode)."""
    return F.when(a.isNotNull(), F.size(a)).otherwise(F.lit(0))


def assemble_features(df: DataFrame, id_col: str, cols: list[str],
                      names_col: str = "feature_names", values_col: str = "features") -> DataFrame:
    """Wide to vector layout: ``id, names array<string>, values array<double>``."""
    return df.select(F.col(qcol(id_col)),
                     F.array(*[F.lit(c) for c in cols]).alias(names_col),
                     F.array(*[F.col(qcol(c)).cast("double") for c in cols]).alias(values_col))


def split_target(df: DataFrame, id_col: str, features_col: str, idx: int) -> DataFrame:
    """Leave-one-out regression input: ``id, features (without idx), target``
    (``idx`` is 1-based)."""
    f = F.col(qcol(features_col))
    return df.select(F.col(qcol(id_col)),
                     filter_array_at_index(f, idx).alias("features"),
                     F.get(f, idx - 1).alias("target"))


def array_concat_agg(df: DataFrame, key: str, order_col: str, arr_col: str,
                     layout: str = "array", out: str = "arr") -> DataFrame:
    """Concatenate the arrays of each key in ``order_col`` order; NULL arrays
    are skipped and a group with no array gives NULL.

    ``layout="array"``: one row per key (bounded by Spark's ~2 GB row limit,
    as the reference's field was by 1 GB). ``layout="long"``: one row per
    element ``(key, pos, value)`` with 1-based positions, computed by the
    skew-proof ordered scan, so no key or array is ever held by one task.
    """
    a = F.col(qcol(arr_col))
    if layout == "array":
        parts = F.collect_list(F.when(a.isNotNull(), F.struct(F.col(qcol(order_col)).alias("o"),
                                                                a.alias("a"))))
        merged = F.transform(F.sort_array(parts), lambda s: s["a"])
        return df.groupBy(qcol(key)).agg(
            F.when(F.size(merged) > 0, F.flatten(merged)).alias(out))
    if layout != "long":
        raise ValueError("layout must be 'array' or 'long'")
    from sparkprep.operators.ordered import running_totals
    base = df.select(F.col(qcol(key)), F.col(qcol(order_col)), a.alias("_a"))
    sized = running_totals(base, key, [order_col], _size0(F.col("_a")), "_end", last_flag="_last")
    start = F.col("_end") - F.size("_a") + 1
    # a key without any element still appears, with NULL position and value, from its last row
    none = F.struct(F.lit(None).cast("long").alias("pos"),
                    F.lit(None).cast(df.schema[arr_col].dataType.elementType).alias("value"))
    elems = F.when(F.size("_a") > 0, F.transform("_a", lambda v, i: F.struct((start + i).cast("long").alias("pos"),
                                                                            v.alias("value"))))
    elems = elems.when(F.col("_last") & (F.col("_end") == 0), F.array(none))
    return sized.select(F.col(qcol(key)), F.explode(elems).alias("_e")).select(
        F.col(qcol(key)), F.col("_e.pos").alias("pos"), F.col("_e.value").alias("value"))


def array_group_size(df: DataFrame, key: str, arr_col: str) -> DataFrame:
    """``key, n_elements, result`` with ``result = 'size of x:N'`` for the
    concatenation of a key's arrays; a partial sum of sizes, the array itself is
    never built (NULL when the key has no array)."""
    a = F.col(qcol(arr_col))
    n = F.sum(F.when(a.isNotNull(), F.size(a)).cast("long"))
    return (df.groupBy(qcol(key)).agg(n.alias("n_elements"))
            .withColumn("result", F.concat(F.lit(GROUP_SIZE_PREFIX), F.col("n_elements").cast("string"))))


def running_accumulate(df: DataFrame, key: str, order_col: str, arr_col: str,
                       final_value=None) -> DataFrame:
    """Accumulate arrays in ``order_col`` order per key: every row reports
    ``'Processing...'`` until ``order_col == final_value`` (a literal or a
    column name; None means each key's last row), which reports
    ``'Size: <MB> MB'`` of everything accumulated so far (8 bytes per element).
    Output ``key, order, n_elements, size_mb, result``."""
    from sparkprep.operators.ordered import running_totals
    a = F.col(qcol(arr_col))
    base = df.select(F.col(qcol(key)), F.col(qcol(order_col)),
                     *([F.col(qcol(final_value))] if isinstance(final_value, str) else []),
                     _size0(a).alias("_n"))
    scanned = running_totals(base, key, [order_col], "_n", "n_elements", last_flag="_last")
    if final_value is None:
        done = F.col("_last")
    elif isinstance(final_value, str):
        done = F.col(qcol(order_col)) == F.col(qcol(final_value))
    else:
        done = F.col(qcol(order_col)) == F.lit(final_value)
    mb = F.round(F.col("n_elements") * F.lit(float(BYTES_PER_VALUE)) / F.lit(1048576.0), 6)
    return scanned.select(
        F.col(qcol(key)), F.col(qcol(order_col)), "n_elements", mb.alias("size_mb"),
        F.when(done, F.concat(F.lit(ACCUMULATE_DONE_PREFIX), F.format_string("%.6f", mb),
                              F.lit(ACCUMULATE_DONE_SUFFIX)))
        .otherwise(F.lit(ACCUMULATE_PENDING)).alias("result"))
