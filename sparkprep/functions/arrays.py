"""Array column expressions. All are built-in Catalyst expressions (no Python)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Distance metrics, as functions of the squared Euclidean distance.
METRICS = {"squared_dist_norm2": lambda d2: d2, "dist_norm2": np.sqrt}


def metric_name(name: str) -> str:
    """The distance metric, with or without a schema prefix; unknown ones raise."""
    plain = name.rsplit(".", 1)[-1]
    if plain not in METRICS:
        raise ValueError(f"unknown distance metric {name!r}; known: {', '.join(METRICS)}")
    return plain


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def filter_array_at_index(arr, idx) -> Column:
    """Drop the element at 1-based position ``idx``; NULL elements are kept.

    Two ``slice`` calls and a ``concat`` stay inside whole-stage codegen, unlike a
    lambda. ``idx`` may be an int or a Column.
    """
    a = _c(arr)
    i = idx if isinstance(idx, Column) else F.lit(int(idx))
    head = F.slice(a, F.lit(1), F.greatest(i - 1, F.lit(0)))
    tail = F.slice(a, i + 1, F.greatest(F.size(a) - i, F.lit(0)))
    return F.when(i > F.size(a), a).otherwise(F.concat(head, tail))


def squared_distance(a, b) -> Column:
    """Squared Euclidean distance between two numeric arrays of equal length."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def closest_columns(centroids, x, m: int = 2, metric: str = "squared_dist_norm2") -> Column:
    """The ``m`` nearest centroids to ``x`` under ``metric`` (``squared_dist_norm2`` or
    ``dist_norm2``). For models beyond a literal's size see ``kmeans.closest_to``.

    Returns ``struct(column_ids array<int>, distances array<double>)`` in ascending
    distance, ties to the lower (0-based) centroid index.
    """
    scored = F.transform(_c(centroids),
                         lambda c, i: F.struct(squared_distance(c, x).alias("d"), i.alias("i")))
    far = F.sqrt if metric_name(metric) == "dist_norm2" else (lambda d: d)
    top = F.slice(F.sort_array(scored), 1, m)
    return F.struct(F.transform(top, lambda s: s["i"]).alias("column_ids"),
                    F.transform(top, lambda s: far(s["d"])).alias("distances"))


def array_struct_sort(arr) -> Column:
    """Ascending sort of an array of structs, field by field with NULL fields
    first (``sort_array``: native ordering, no lambda comparator)."""
    return F.sort_array(_c(arr))
