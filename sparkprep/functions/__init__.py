from sparkprep.functions.hashing import hash_uniform, hash_uniform_sql
from sparkprep.functions.arrays import (
    filter_array_at_index, closest_columns, squared_distance, array_struct_sort,
)
from sparkprep.functions.formatting import format_bytes, format_bytes_sql

__all__ = [
    "hash_uniform", "hash_uniform_sql", "filter_array_at_index", "closest_columns",
    "squared_distance", "array_struct_sort", "format_bytes", "format_bytes_sql",
]
