"""Flagship: the reference's three scripts chained, on the ``part`` table.

wide features with NULLs and collinear columns
  -> mean imputation + z-scores into named vectors   (one stats job)
  -> VIF screening on the normalised vectors          (one Gram job per NULL-affected step)
  -> K-means sweeps over K = 8..36, random and D^2 seeding (one job per iteration for all K)
  -> one table of both sweeps ranked by silhouette.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.constants import ALGO_KMEANSPP, ALGO_RANDOM, KMEANS_SWEEP_KS, VIF_THRESHOLD
from sparkprep.operators import impute, kmeans, vif
from sparkprep.sources.tables import read_table

KS = KMEANS_SWEEP_KS


def flagship_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    size = F.col("p_size").cast("double")
    price = F.col("p_retailprice")
    return read_table(spark, sf_dir, "part").select(
        k.alias("id"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(size).alias("f_size"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(price).alias("f_price"),
        (F.lit(2.0) * size + F.lit(0.01) * price + (k % 5).cast("double")).alias("f_mix"),
        (k % 13).cast("double").alias("f_mod"),
        (F.lit(3.0) * size).alias("f_size3"),
        (k % 3).alias("label"),
    )


def flagship(spark: SparkSession, sf_dir: str, ks=KS, threshold: float = VIF_THRESHOLD,
             num_steps: int = 20) -> DataFrame:
    wide = flagship_input(spark, sf_dir)
    vectors = impute.impute_normalize_vectors(wide, "id", label_col="label", unique_id=True)
    screened = vif.vif_select_vectors(vectors, "id", "feat_name_vect", "feat_vect_normalized",
                                      threshold=threshold, num_steps=num_steps)
    pts = screened.reduced
    both = kmeans.kmeans_sweeps(pts, "id", "feat_vect_normalized", ks,
                                inits=("random", "kmeanspp"))
    return kmeans.kmeans_compare(both)


# ---------------------------------------------------------------- oracle SQL
NAMES = ["f_mix", "f_mod", "f_price", "f_size", "f_size3"]

INPUT_SQL = """SELECT p_partkey AS id,
    CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS f_size,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS f_price,
    2.0 * CAST(p_size AS DOUBLE) + CAST(0.01 AS DOUBLE) * p_retailprice
        + CAST(p_partkey % 5 AS DOUBLE) AS f_mix,
    CAST(p_partkey % 13 AS DOUBLE) AS f_mod,
    3.0 * CAST(p_size AS DOUBLE) AS f_size3,
    p_partkey % 3 AS label
    FROM part"""


def flagship_sql(ks=KS, threshold: float = VIF_THRESHOLD, num_steps: int = 20) -> str:
    """The flagship in DuckDB SQL: imputation, the unrolled VIF loop, vectors
    of the kept features, then both unrolled K-means sweeps."""
    from sparkprep.plans import oracle_sql as osql
    from sparkprep.plans.rounding import r6_sql, sig_sql
    aggs = ", ".join(f"avg({n}) AS a_{n}, stddev_samp({n}) AS s_{n}" for n in NAMES)
    norm = ", ".join(f"(coalesce({n}, a_{n}) - a_{n}) / s_{n} AS {n}" for n in NAMES)
    normed = (f"SELECT fi.id, {norm} FROM ({INPUT_SQL}) fi, "
              f"(SELECT {aggs} FROM ({INPUT_SQL})) st")
    steps = osql.vif_steps_sql(normed, NAMES, threshold, num_steps)
    long_rows = " UNION ALL ".join(f"SELECT id, '{n}' AS name, {n} AS v FROM nz" for n in NAMES)
    points = (f"WITH nz AS ({normed}), dropped AS (SELECT feature_w_max_vif AS name FROM ({steps}) "
              f"WHERE vif >= {threshold!r}) SELECT id, list(v ORDER BY name) AS x FROM ({long_rows}) "
              f"WHERE name NOT IN (SELECT name FROM dropped) GROUP BY id")
    parts = []
    for init, label in (("random", ALGO_RANDOM), ("kmeanspp", ALGO_KMEANSPP)):
        inner = osql.kmeans_sql(points, list(ks), init)
        parts.append(f"SELECT '{label}' AS algo_type, CAST(num_clusters AS BIGINT) AS num_clusters, "
                     f"{sig_sql('objective_fn')} AS objective_fn, "
                     f"{r6_sql('frac_reassigned')} AS frac_reassigned, "
                     f"CAST(num_iterations AS BIGINT) AS num_iterations, "
                     f"{r6_sql('simple_silhouette')} AS simple_silhouette FROM ({inner})")
    return " UNION ALL ".join(parts)
