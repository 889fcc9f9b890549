"""sparkprep: feature preparation and grouped modelling on Spark DataFrames.

Every operator takes and returns DataFrames. Heavy work (scans, aggregates,
per-partition NumPy partial sums) runs on executors; the driver only ever
holds small model state (a p x p matrix, K x d centroids, a few counts).
"""

from sparkprep.functions import closest_columns, filter_array_at_index, hash_uniform
from sparkprep.operators.arrays import (array_concat_agg, array_group_size, assemble_features,
                                        running_accumulate, split_target)
from sparkprep.operators.gram import gram_matrix, gram_stats
from sparkprep.operators.impute import (column_stats, impute_normalize_columns,
                                        impute_normalize_vectors)
from sparkprep.operators.kmeans import (kmeans, kmeans_compare, kmeans_sweep, kmeans_sweeps,
                                        simple_silhouette)
from sparkprep.operators.linear import (grouped_train, linregr, ridge_by_group,
                                        ridge_by_group_rows, streaming_ridge_trainer)
from sparkprep.operators.ordered import running_totals
from sparkprep.operators.report import matrix_size_report, table_size_report
from sparkprep.operators.schema import feature_columns
from sparkprep.operators.synth import replicate_shuffle, synth_array, synth_uniform
from sparkprep.operators.vif import VifResult, vif_scores, vif_select_columns, vif_select_vectors
from sparkprep.session import checkpoint_dir, get_spark

__all__ = [
    "feature_columns", "column_stats", "impute_normalize_vectors", "impute_normalize_columns",
    "filter_array_at_index", "assemble_features", "split_target", "gram_stats", "gram_matrix",
    "linregr", "vif_scores", "vif_select_columns", "vif_select_vectors", "VifResult",
    "kmeans", "kmeans_sweep", "kmeans_sweeps", "kmeans_compare", "closest_columns",
    "simple_silhouette", "synth_array", "synth_uniform", "array_concat_agg",
    "array_group_size", "running_accumulate", "replicate_shuffle", "ridge_by_group",
    "ridge_by_group_rows", "grouped_train", "streaming_ridge_trainer", "matrix_size_report",
    "table_size_report", "running_totals", "hash_uniform", "get_spark", "checkpoint_dir",
]
