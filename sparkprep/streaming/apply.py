"""Apply batch-fitted imputation statistics to a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sparkprep.operators.impute import apply_normalization


def normalize_stream(stream_df: DataFrame, stats: dict[str, tuple], id_col: str) -> DataFrame:
    """``id, <col>_normalized ...`` for every micro-batch, from ``{name: (mean, stddev)}``
    fitted on a batch table (``impute.surviving_features``). No state is kept."""
    return apply_normalization(stream_df, stats, id_col)
