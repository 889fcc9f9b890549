"""Deterministic pseudo-random numbers as pure functions of (key, seed).

The reference draws unseeded ``random()``. Here every random choice is a hash
of the row's key and a seed, so results repeat exactly, do not depend on the
partitioning, survive task retries, and can be recomputed by an independent
SQL engine:

    u = (int(first 13 hex digits of md5("k1:k2:...:seed"), 16) + 0.5) / 2**52

which is exact in a double and lies strictly inside (0, 1). Of n keys about n**2 / 2**53 pairs
share a value, so ties stay rare up to some hundred million keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13
_RANGE = float(16 ** _DIGITS)


def hash_uniform(*keys, seed: int | str = 42) -> Column:
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    text = F.concat_ws(":", *parts, F.lit(str(seed)))
    word = F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("double")
    return (word + F.lit(0.5)) / F.lit(_RANGE)


def hash_uniform_sql(*keys: str, seed: int | str = 42) -> str:
    """The same value as DuckDB SQL text (keys are SQL expressions)."""
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"((CAST(('0x' || substr(md5(concat_ws(':', {parts}, '{seed}')), 1, {_DIGITS})) AS BIGINT)"
            f" + 0.5) / CAST({_RANGE!r} AS DOUBLE))")
