"""Output normalisation shared by registered queries and their oracle SQL.

Doubles are compared after rounding: ``r6`` to 6 decimal places for values of
order one, ``sig`` to 10 significant digits for sums whose magnitude varies.
Adding 0.0 turns a negative zero into zero in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def r6(x) -> Column:
    return F.round(_c(x).cast("double"), 6) + F.lit(0.0)


def sig(x) -> Column:
    return F.format_string("%.9e", _c(x).cast("double")).cast("double") + F.lit(0.0)


def r6_sql(x: str) -> str:
    return f"(round(CAST({x} AS DOUBLE), 6) + 0.0)"


def sig_sql(x: str) -> str:
    return f"(CAST(printf('%.9e', CAST({x} AS DOUBLE)) AS DOUBLE) + 0.0)"


def explode_vector(df, keys: list[str], arrays: dict[str, str], pos: str = "pos",
                   round_cols: dict | None = None, outer: bool = False):
    """``(keys..., pos, <array elements>)`` rows with 1-based positions."""
    names = list(arrays)
    zipped = F.arrays_zip(*[F.col(arrays[n]).alias(n) for n in names])
    gen = F.posexplode_outer if outer else F.posexplode
    ex = df.select(*keys, gen(zipped).alias("_p", "_z"))
    round_cols = round_cols or {}
    out = [F.col(k) for k in keys] + [(F.col("_p") + 1).cast("long").alias(pos)]
    for n in names:
        v = F.col("_z")[n]
        fn = round_cols.get(n)
        out.append((fn(v) if fn else v).alias(n))
    return ex.select(*out)
