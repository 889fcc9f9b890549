"""Feature discovery from the DataFrame schema (no Spark job)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def feature_columns(df: DataFrame, exclude: Iterable[str] = (), types=None,
                    order: str = "name") -> list[str]:
    """Columns of ``df`` not in ``exclude``.

    ``types``: None keeps every numeric column; otherwise a tuple of Spark type
    classes to keep. ``order``: ``"name"`` (code-point order) or ``"ordinal"``
    (schema order). An empty ``exclude`` means no exclusion.
    """
    if order not in ("name", "ordinal"):
        raise ValueError("order must be 'name' or 'ordinal'")
    dropped = set(exclude or ())
    keep = tuple(types) if types is not None else NUMERIC_TYPES
    names: list[str] = []
    for f in df.schema.fields:
        if f.name in dropped or f.name in names:
            continue
        if isinstance(f.dataType, keep):
            names.append(f.name)
    return sorted(names) if order == "name" else names


def qcol(name: str) -> str:
    """Backtick-quote a column name for use in expressions."""
    return "`" + name.replace("`", "``") + "`"
