"""User-level operators. Each takes and returns DataFrames."""
