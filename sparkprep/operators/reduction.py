"""Partial results of many tasks combined in a tree, and sums that do not depend on order.

Sums of doubles differ with the order of addition, hence with the partitioning. Here a value is
first rounded to a grid of 72 bits below a power of two that bounds its column, and split into
whole numbers of 24 bits; these are added exactly, in any order and any tree, so a table gives
the same bits however it is partitioned. The rounding (2**-72 of the column's largest value) lies far
below that of adding doubles. Long sums of the parts hold for 2**38 rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Partial rows that one group of the tree combines.
FAN = 32
#: Values of partial rows that the driver takes as the tree's last node (beyond one row for each key).
DRIVER_VALUES = 4_000_000
_BITS, PARTS = 24, 3
_STEP = float(1 << _BITS)


def exponents(largest: np.ndarray) -> np.ndarray:
    """Per column the power of two above its largest absolute value."""
    return np.frexp(np.maximum(np.asarray(largest, dtype=np.float64), 0.0))[1]


def split(x: np.ndarray, exp: np.ndarray) -> np.ndarray:
    """Rows (n, d) as whole numbers (n, 3 d), of at most 24 bits each."""
    # two powers of two, each within the range of doubles whatever the exponent
    half = (_BITS - exp) // 2
    rest = x * np.ldexp(1.0, half) * np.ldexp(1.0, _BITS - exp - half)
    out = np.empty((*x.shape[:-1], x.shape[-1] * PARTS))
    d = x.shape[-1]
    for i in range(PARTS):
        whole = out[..., i * d:(i + 1) * d]
        if i == PARTS - 1:
            np.rint(rest, out=whole)
            break
        np.trunc(rest, out=whole)
        rest -= whole
        rest *= _STEP
    return out


def value(parts: np.ndarray, exp: np.ndarray) -> np.ndarray:
    """The sums as doubles from the sums of the parts."""
    d = parts.shape[-1] // PARTS
    hi, mid, lo = (parts[..., i * d:(i + 1) * d].astype(np.float64) for i in range(PARTS))
    return np.ldexp((hi * _STEP + mid) * _STEP + lo, exp - _BITS * PARTS)


def _elementwise(c: str, join) -> Column:
    items = F.collect_list(c)
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), F.element_at(items, 1),
                       lambda acc, e: F.zip_with(acc, e, join))


def tree(partials: DataFrame, keys: list[str], parts: int, sums: list[str], arrays: list[str] = (),
         largest: bool = False, driver_rows: int | None = None) -> list[dict]:
    """Per key, the sums of long columns and the element-wise sums (or maxima) of array columns.

    ``partials`` has a ``pid`` below ``parts``. Rows of ``FAN`` neighbouring tasks meet per key, level
    after level, until at most ``driver_rows`` (default ``FAN``) tasks' worth is left, which the driver adds.
    """
    rows_left = max(1, FAN if driver_rows is None else driver_rows)
    join = (lambda a, b: F.greatest(a, b)) if largest else (lambda a, b: a + b)
    while parts > rows_left:
        unit = F.floor(F.col("pid") / F.lit(FAN)).cast("int").alias("pid")
        partials = partials.groupBy(*keys, unit).agg(
            *[F.sum(c).alias(c) for c in sums], *[_elementwise(c, join).alias(c) for c in arrays])
        parts = -(-parts // FAN)
    out: dict = {}
    for r in partials.collect():
        kk = tuple(r[k] for k in keys)
        got = {**{c: r[c] for c in sums}, **{c: np.array(r[c]) for c in arrays}}
        if kk in out:
            held = out[kk]
            got = {**{c: held[c] + got[c] for c in sums},
                   **{c: np.maximum(held[c], got[c]) if largest else held[c] + got[c] for c in arrays}}
        out[kk] = got
    return [{**dict(zip(keys, kk)), **v} for kk, v in out.items()]


def driver_rows(values_per_task: int) -> int:
    """Tasks whose partial rows the driver may take at once."""
    return max(1, min(FAN, DRIVER_VALUES // max(1, values_per_task)))
