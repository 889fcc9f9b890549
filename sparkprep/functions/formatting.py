"""Human-readable byte sizes: the largest unit (powers of 1024) in which the
value is at least 10, rounded half up to a whole number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names in order of size.
UNITS = ["bytes", "kB", "MB", "GB", "TB", "PB"]


def format_bytes(b) -> Column:
    b = (F.col(b) if isinstance(b, str) else b).cast("double")
    expr = None
    for power in range(len(UNITS) - 1, 0, -1):
        scaled = F.floor(b / F.lit(1024.0 ** power) + F.lit(0.5)).cast("long")
        text = F.concat(scaled.cast("string"), F.lit(" " + UNITS[power]))
        cond = b >= F.lit(10 * 1024.0 ** power)
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    bytes_text = F.concat(b.cast("long").cast("string"), F.lit(" bytes"))
    return expr.otherwise(bytes_text)


def format_bytes_sql(b: str) -> str:
    parts = []
    for power in range(len(UNITS) - 1, 0, -1):
        lim = 10 * 1024.0 ** power
        parts.append(f"WHEN CAST({b} AS DOUBLE) >= {lim!r} THEN "
                     f"CAST(CAST(floor(CAST({b} AS DOUBLE) / {1024.0 ** power!r} + 0.5) AS BIGINT) AS VARCHAR)"
                     f" || ' {UNITS[power]}'")
    return ("(CASE " + " ".join(parts)
            + f" ELSE CAST(CAST({b} AS BIGINT) AS VARCHAR) || ' bytes' END)")
