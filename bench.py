"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is forced to full execution with the no-op sink; K-means, VIF and
the ordered scans run their jobs while the result DataFrame is built, which
is inside the timed region too. A warm-up on small synthetic data (untimed)
absorbs JVM JIT and Python-worker start-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship", "column_stats", "impute_normalize_vectors", "impute_normalize_vectors_dup_ids",
    "impute_normalize_columns", "gram_matrix", "linregr_train", "vif_select_columns",
    "vif_select_vectors", "kmeans_random", "kmeanspp", "kmeans_sweep", "kmeans_compare",
    "impute_normalize_vectors_long", "ridge_by_group",
    "ridge_by_group_rows", "grouped_train", "array_concat_agg", "array_concat_agg_long",
    "running_accumulate", "replicate_shuffle", "synth_array", "matrix_size_report",
]


def _warm_up(spark) -> None:
    from pyspark.sql import functions as F

    from sparkprep.functions.hashing import hash_uniform
    from sparkprep.operators import impute, kmeans
    from sparkprep.operators.ordered import running_totals
    pts = spark.range(1, 3001).select(
        F.col("id"), F.array(*[hash_uniform("id", F.lit(j)) for j in range(8)]).alias("x"))
    kmeans.kmeans_sweeps(pts, "id", "x", [4, 8], max_iter=5).collect()
    wide = pts.select("id", *[F.col("x")[j].alias(f"f{j}") for j in range(8)])
    impute.impute_normalize_vectors(wide, "id", unique_id=True).write.format("noop").mode("overwrite").save()
    running_totals(pts.select((F.col("id") % 7).alias("k"), "id"), "k", ["id"], F.lit(1)).count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from sparkprep.plans.registry import QUERIES
    from sparkprep.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", app="sparkprep-bench")
    # warm-up on small synthetic data (not timed): JVM JIT, code generation and
    # Python workers with NumPy loaded, so no headline query pays start-up
    _warm_up(spark)
    times = {}
    for key in HEADLINE:
        t0 = time.time()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds_headline_queries",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
