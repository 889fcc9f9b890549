"""Registered queries: ``key -> (spark, sf_dir) -> DataFrame`` and the DuckDB
oracle SQL for the same key.

Every query reads whole tables from ``sf_dir`` (fixtures in
``sparkprep.sources.fixtures``). Doubles are rounded (``plans.rounding``),
integers are BIGINT, arrays are exploded to ``(key, pos, value)`` rows, so
the driver's order-insensitive compare sees identical values in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep import constants as C
from sparkprep.constants import KMEANS_SWEEP_KS
from sparkprep.functions.arrays import closest_columns, filter_array_at_index
from sparkprep.functions.formatting import format_bytes_sql
from sparkprep.functions.hashing import hash_uniform, hash_uniform_sql
from sparkprep.operators import arrays as arr_ops
from sparkprep.operators import gram as gram_ops
from sparkprep.operators import impute, linear, report, synth, vif
from sparkprep.operators import kmeans as km
from sparkprep.plans import oracle_sql as osql
from sparkprep.plans.rounding import explode_vector, r6, r6_sql, sig, sig_sql
from sparkprep.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def query(key: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- imputation
F1_FEATURES = ["f_const", "f_null", "f_price", "f_size"]


def _stats_sql(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, avg(CAST({c} AS DOUBLE)) AS a, "
             f"stddev_samp(CAST({c} AS DOUBLE)) AS s FROM ({src})" for c in cols]
    return " UNION ALL ".join(parts)


def _column_stats_sql() -> str:
    return (f"SELECT column_name, {r6_sql('a')} AS avg, {r6_sql('s')} AS stddev "
            f"FROM ({_stats_sql(fx.f1_sql(), F1_FEATURES)}) WHERE s > 0")


@query("column_stats", _column_stats_sql)
def q_column_stats(spark, sf):
    df = fx.f1_wide(spark, sf)
    cols = impute.feature_columns(df, exclude=["id", "label", "year"])
    return impute.column_stats(df, cols).select(
        "column_name", r6("avg").alias("avg"), r6("stddev").alias("stddev"))


def _impute_vectors_sql(dup_ids: bool) -> str:
    src = fx.f1_sql(dup_ids)
    longs = " UNION ALL ".join(
        f"SELECT id, label, '{c}' AS feat_name, CAST({c} AS DOUBLE) AS feat FROM ({src})"
        for c in F1_FEATURES)
    return f"""
    WITH st AS ({_stats_sql(src, F1_FEATURES)}),
    lg AS (
        SELECT l.id, l.label, l.feat_name, l.feat,
               (coalesce(l.feat, st.a) - st.a) / st.s AS feat_normalized
        FROM ({longs}) l JOIN st ON st.column_name = l.feat_name WHERE st.s > 0
        UNION ALL
        SELECT id, label, '{C.CONSTANT_TERM}', 1.0, 1.0 FROM ({src})
    )
    SELECT id, label,
           CAST(row_number() OVER (PARTITION BY id, label
                ORDER BY feat_name, feat NULLS FIRST) AS BIGINT) AS pos,
           feat_name, {r6_sql('feat')} AS feat, {r6_sql('feat_normalized')} AS feat_normalized
    FROM lg"""


def _impute_vectors(spark, sf, dup_ids):
    df = fx.f1_wide(spark, sf, dup_ids=dup_ids)
    out = impute.impute_normalize_vectors(df, "id", exclude=["year"], label_col="label",
                                          constant_term=True, unique_id=not dup_ids)
    return explode_vector(out, ["id", "label"],
                          {"feat_name": "feat_name_vect", "feat": "feat_vect",
                           "feat_normalized": "feat_vect_normalized"},
                          round_cols={"feat": r6, "feat_normalized": r6})


@query("impute_normalize_vectors", lambda: _impute_vectors_sql(False))
def q_impute_vectors(spark, sf):
    return _impute_vectors(spark, sf, False)


@query("impute_normalize_vectors_dup_ids", lambda: _impute_vectors_sql(True))
def q_impute_vectors_dups(spark, sf):
    return _impute_vectors(spark, sf, True)


@query("impute_normalize_vectors_long", lambda: _impute_vectors_sql(True))
def q_impute_vectors_long(spark, sf):
    df = fx.f1_wide(spark, sf, dup_ids=True)
    out = impute.impute_normalize_vectors(df, "id", exclude=["year"], label_col="label",
                                          constant_term=True, layout="long")
    return out.select("id", "label", "pos", "feat_name", r6("feat").alias("feat"),
                      r6("feat_normalized").alias("feat_normalized"))


def _impute_columns_sql() -> str:
    src = fx.f1_sql()
    st = _stats_sql(src, ["f_price", "f_size"])
    return f"""
    WITH st AS ({st}),
    p AS (SELECT a, s FROM st WHERE column_name = 'f_price' AND s > 0),
    z AS (SELECT a, s FROM st WHERE column_name = 'f_size' AND s > 0)
    SELECT f.id,
        {r6_sql('(coalesce(CAST(f.f_price AS DOUBLE), p.a) - p.a) / p.s')} AS f_price_normalized,
        {r6_sql('(coalesce(CAST(f.f_size AS DOUBLE), z.a) - z.a) / z.s')} AS f_size_normalized
    FROM ({src}) f, p, z"""


@query("impute_normalize_columns", _impute_columns_sql)
def q_impute_columns(spark, sf):
    out = impute.impute_normalize_columns(fx.f1_wide(spark, sf), "id",
                                          exclude=["label", "year"])
    return out.select("id", *[r6(c).alias(c) for c in out.columns if c != "id"])


# ---------------------------------------------------------------- array rows

F3_COLS = ["x1", "x2", "x3", "x4"]
F4_COLS = ["x1", "x2", "x3", "x4", "x5"]


def _vectors_sql(exact=False, nulls=False, cols=None):
    return fx.to_vectors_sql(fx.f3_sql(exact, nulls), cols or F3_COLS)


def _filter_index_sql() -> str:
    return f"""
    SELECT id, CAST(CASE WHEN k < 2 THEN k ELSE k - 1 END AS BIGINT) AS pos,
           feature_names[k] AS feature_name, {r6_sql('features[k]')} AS feature
    FROM (SELECT id, feature_names, features, unnest(generate_series(1, len(features))) AS k
          FROM ({_vectors_sql()})) WHERE k <> 2"""


@query("filter_array_at_index", _filter_index_sql)
def q_filter_index(spark, sf):
    v = fx.to_vectors(fx.f3_collinear(spark, sf), "id", F3_COLS)
    out = v.select("id", filter_array_at_index("feature_names", 2).alias("n"),
                   filter_array_at_index("features", 2).alias("x"))
    return explode_vector(out, ["id"], {"feature_name": "n", "feature": "x"},
                          round_cols={"feature": r6})


def _assemble_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT id, {j + 1} AS pos, '{c}' AS feature_name, CAST({c} AS DOUBLE) AS feature FROM ({fx.f3_sql()})"
        for j, c in enumerate(F3_COLS))
    return (f"SELECT id, CAST(pos AS BIGINT) AS pos, feature_name, {r6_sql('feature')} AS feature "
            f"FROM ({parts})")


@query("assemble_features", _assemble_sql)
def q_assemble(spark, sf):
    v = arr_ops.assemble_features(fx.f3_collinear(spark, sf), "id", F3_COLS)
    return explode_vector(v, ["id"], {"feature_name": "feature_names", "feature": "features"},
                          round_cols={"feature": r6})


def _split_target_sql() -> str:
    return f"""
    SELECT id, {r6_sql('features[3]')} AS target,
           CAST(CASE WHEN k < 3 THEN k ELSE k - 1 END AS BIGINT) AS pos,
           {r6_sql('features[k]')} AS feature
    FROM (SELECT id, features, unnest(generate_series(1, len(features))) AS k
          FROM ({_vectors_sql()})) WHERE k <> 3"""


@query("split_target", _split_target_sql)
def q_split_target(spark, sf):
    v = fx.to_vectors(fx.f3_collinear(spark, sf), "id", F3_COLS)
    out = arr_ops.split_target(v, "id", "features", 3).withColumn("target", r6("target"))
    return explode_vector(out, ["id", "target"], {"feature": "features"},
                          round_cols={"feature": r6})


# ---------------------------------------------------------- Gram, OLS, VIF


def _gram_sql() -> str:
    nn = " AND ".join(f"{c} IS NOT NULL" for c in F3_COLS)
    lg = " UNION ALL ".join(f"SELECT id, {j + 1} AS j, CAST({c} AS DOUBLE) AS v FROM f"
                            for j, c in enumerate(F3_COLS))
    return f"""
    WITH f AS (SELECT * FROM ({fx.f3_sql()}) WHERE {nn}), lg AS ({lg})
    SELECT CAST(a.j AS BIGINT) AS i, CAST(b.j AS BIGINT) AS j, CAST(count(*) AS BIGINT) AS n,
           {sig_sql('sum(a.v)')} AS sum_i, {sig_sql('sum(a.v * b.v)')} AS xtx
    FROM lg a JOIN lg b ON a.id = b.id GROUP BY a.j, b.j"""


@query("gram_matrix", _gram_sql)
def q_gram(spark, sf):
    g = gram_ops.gram_matrix(fx.f3_collinear(spark, sf), F3_COLS)
    return g.select("i", "j", "n", sig("sum_i").alias("sum_i"), sig("xtx").alias("xtx"))


def _gram_xy_sql() -> str:
    cols = ["x1", "x2", "x4", "x3"]
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    lg = " UNION ALL ".join(f"SELECT id, {j + 1} AS j, CAST({c} AS DOUBLE) AS v FROM f"
                            for j, c in enumerate(cols))
    return f"""
    WITH f AS (SELECT * FROM ({fx.f3_sql(nulls=True)}) WHERE {nn}), lg AS ({lg})
    SELECT CAST(a.j AS BIGINT) AS i, CAST(b.j AS BIGINT) AS j, CAST(count(*) AS BIGINT) AS n,
           {sig_sql('sum(a.v)')} AS sum_i, {sig_sql('sum(a.v * b.v)')} AS xtx
    FROM lg a JOIN lg b ON a.id = b.id GROUP BY a.j, b.j"""


@query("gram_matrix_target", _gram_xy_sql)
def q_gram_xy(spark, sf):
    g = gram_ops.gram_matrix(fx.f3_collinear(spark, sf, nulls=True), ["x1", "x2", "x4"], target_col="x3")
    return g.select("i", "j", "n", sig("sum_i").alias("sum_i"), sig("xtx").alias("xtx"))


def _linregr_sql() -> str:
    inner = osql.linregr_sql(fx.f3_sql(), "x3", ["x1", "x2", "x4"])
    return f"SELECT idx, {r6_sql('coef')} AS coef, {r6_sql('r2')} AS r2, num_rows FROM ({inner})"


@query("linregr_train", _linregr_sql)
def q_linregr(spark, sf):
    out = linear.linregr(fx.f3_collinear(spark, sf), "x3", ["x1", "x2", "x4"])
    return (out.select(F.posexplode("coef").alias("p", "c"), "r2", "num_rows")
            .select((F.col("p") + 1).cast("long").alias("idx"), r6("c").alias("coef"),
                    r6("r2").alias("r2"), "num_rows"))


def _vif_scores_sql() -> str:
    inner = osql.vif_steps_sql(fx.f3_sql(), F3_COLS, 10.0, 1, scores_only=True)
    return f"SELECT feature, {sig_sql('vif')} AS vif FROM ({inner})"


@query("vif_scores", _vif_scores_sql)
def q_vif_scores(spark, sf):
    return vif.vif_scores(fx.f3_collinear(spark, sf), F3_COLS).select(
        "feature", sig("vif").alias("vif"))


def _vif_intercept_sql() -> str:
    inner = osql.vif_steps_sql(fx.f3_sql(), F3_COLS, 10.0, 1, scores_only=True, intercept=True)
    return f"SELECT feature, {sig_sql('vif')} AS vif FROM ({inner})"


@query("vif_scores_intercept", _vif_intercept_sql)
def q_vif_scores_intercept(spark, sf):
    return vif.vif_scores(fx.f3_collinear(spark, sf), F3_COLS, intercept=True).select(
        "feature", sig("vif").alias("vif"))


def _steps_out(steps_df):
    return steps_df.select(F.col("step").cast("long").alias("step"), "feature_w_max_vif",
                           sig("vif").alias("vif"), "discarded")


def _steps_sql(inner: str) -> str:
    return (f"SELECT CAST(step AS BIGINT) AS step, feature_w_max_vif, {sig_sql('vif')} AS vif, "
            f"discarded FROM ({inner})")


@query("vif_select_columns",
       lambda: _steps_sql(osql.vif_steps_sql(fx.f3_sql(exact=True), F4_COLS, 10.0, 10)))
def q_vif_columns(spark, sf):
    res = vif.vif_select_columns(fx.f3_collinear(spark, sf, exact=True), "id",
                                 threshold=10.0, num_steps=10)
    return _steps_out(res.steps)


@query("vif_select_vectors",
       lambda: _steps_sql(osql.vif_steps_sql(fx.f3_sql(exact=True, nulls=True), F4_COLS, 10.0, 20)))
def q_vif_vectors(spark, sf):
    v = fx.to_vectors(fx.f3_collinear(spark, sf, exact=True, nulls=True), "id", F4_COLS)
    res = vif.vif_select_vectors(v, "id", "feature_names", "features",
                                 threshold=10.0, num_steps=20)
    return _steps_out(res.steps)


# 18 columns of which five depend on others: embeddings' first entries, sums and multiples of them
WIDE_BASE = 13
WIDE_MORE = {"g1": ("f01", "f02"), "g2": ("f03", "f03"), "g3": ("f04", "g1"), "g4": ("f05", "f06"), "g5": ("g4", "f07")}
WIDE_COLS = [f"f{i:02d}" for i in range(1, WIDE_BASE + 1)] + list(WIDE_MORE)


def _vif_wide_src() -> str:
    base = ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS f{i:02d}" for i in range(1, WIDE_BASE + 1))
    src = f"SELECT vec_id AS id, {base} FROM embeddings"
    for name, (a, b) in WIDE_MORE.items():
        src = f"SELECT *, {a} + {b} AS {name} FROM ({src})"
    return src


@query("vif_select_wide", lambda: _steps_sql(osql.vif_steps_sql(_vif_wide_src(), WIDE_COLS, 10.0, 6)))
def q_vif_wide(spark, sf):
    from sparkprep.sources.tables import read_table
    e = read_table(spark, sf, "embeddings")
    wide = e.select(F.col("vec_id").alias("id"), *[F.get("embedding", F.lit(i)).cast("double").alias(f"f{i + 1:02d}")
                                                   for i in range(WIDE_BASE)])
    for name, (a, b) in WIDE_MORE.items():
        wide = wide.withColumn(name, F.col(a) + F.col(b))
    return _steps_out(vif.vif_select_columns(wide, "id", threshold=10.0, num_steps=6).steps)


# ---------------------------------------------------------- grouped ridge
def r4(x):
    return F.round(F.col(x) if isinstance(x, str) else x, 4) + F.lit(0.0)


def r4_sql(x: str) -> str:
    return f"(round(CAST({x} AS DOUBLE), 4) + 0.0)"


def _ridge_out(df, key, extra=()):
    return (df.select(key, *extra, F.posexplode("coef").alias("p", "c"), "intercept", "r_square")
            .select(key, *extra, (F.col("p") + 1).cast("long").alias("idx"), r4("c").alias("coef"),
                    r4("intercept").alias("intercept"), r6("r_square").alias("r_square")))


def _ridge_sql_out(inner: str, key: str, extra: str = "") -> str:
    return (f"SELECT {key}{extra}, idx, {r4_sql('coef')} AS coef, {r4_sql('intercept')} AS intercept, "
            f"{r6_sql('r_square')} AS r_square FROM ({inner})")


@query("ridge_by_group", lambda: _ridge_sql_out(
    osql.ridge_sql(fx.F9_SQL, "model", ["features[1]", "features[2]", "features[3]"], "label", 0.5),
    "model"))
def q_ridge(spark, sf):
    out = linear.ridge_by_group(fx.f9_lineitem(spark, sf), "model", "features", "label",
                                alpha=0.5, p=3)
    return _ridge_out(out, "model")


SEG_SQL = ("SELECT c_mktsegment, [CAST(c_nationkey AS DOUBLE), CAST(c_custkey % 100 AS DOUBLE)]"
           " AS features, c_acctbal AS label FROM customer")


@query("ridge_by_segment", lambda: _ridge_sql_out(
    osql.ridge_sql(SEG_SQL, "c_mktsegment", ["features[1]", "features[2]"], "label", 0.5),
    "c_mktsegment"))
def q_ridge_segment(spark, sf):
    from sparkprep.sources.tables import read_table
    c = read_table(spark, sf, "customer").select(
        "c_mktsegment",
        F.array(F.col("c_nationkey").cast("double"), (F.col("c_custkey") % 100).cast("double"))
        .alias("features"),
        F.col("c_acctbal").alias("label"))
    out = linear.ridge_by_group(c, "c_mktsegment", "features", "label", alpha=0.5, p=2)
    return _ridge_out(out, "c_mktsegment")


GT_SQL = ("SELECT o_orderpriority, [CAST(o_custkey % 100 AS DOUBLE), CAST(o_orderkey % 7 AS DOUBLE)]"
          " AS features, o_totalprice AS label FROM orders")


@query("grouped_train", lambda: _ridge_sql_out(
    osql.ridge_sql(GT_SQL, "o_orderpriority", ["features[1]", "features[2]"], "label", 0.5),
    "o_orderpriority"))
def q_grouped_train(spark, sf):
    from sparkprep.sources.tables import read_table
    o = read_table(spark, sf, "orders").select(
        "o_orderpriority",
        F.array((F.col("o_custkey") % 100).cast("double"),
                (F.col("o_orderkey") % 7).cast("double")).alias("features"),
        F.col("o_totalprice").alias("label"))
    out = linear.grouped_train(o, "o_orderpriority", linear.RidgeTrainer("features", "label", 0.5))
    return _ridge_out(out, "o_orderpriority")


GTM_SQL = ("SELECT o_custkey % 50 AS model, [CAST(o_custkey % 100 AS DOUBLE), CAST(o_orderkey % 7 AS DOUBLE)]"
           " AS features, o_totalprice AS label FROM orders")


@query("grouped_train_many", lambda: _ridge_sql_out(
    osql.ridge_sql(GTM_SQL, "model", ["features[1]", "features[2]"], "label", 0.5), "model"))
def q_grouped_train_many(spark, sf):
    """Many groups, each trained from the states of all tasks that hold its rows."""
    from sparkprep.sources.tables import read_table
    o = read_table(spark, sf, "orders").select(
        (F.col("o_custkey") % 50).alias("model"),
        F.array((F.col("o_custkey") % 100).cast("double"), (F.col("o_orderkey") % 7).cast("double")).alias("features"),
        F.col("o_totalprice").alias("label"))
    return _ridge_out(linear.grouped_train(o, "model", linear.RidgeTrainer("features", "label", 0.5)), "model")


# ------------------------------------------------------------------ K-means

SWEEP_KS = KMEANS_SWEEP_KS


def _km_summary(df):
    return df.select(F.col("num_clusters").cast("long").alias("num_clusters"),
                     sig("objective_fn").alias("objective_fn"),
                     r6("frac_reassigned").alias("frac_reassigned"),
                     F.col("num_iterations").cast("long").alias("num_iterations"),
                     r6("simple_silhouette").alias("simple_silhouette"))


def _km_summary_sql(inner: str, extra: str = "") -> str:
    return (f"SELECT {extra}CAST(num_clusters AS BIGINT) AS num_clusters, "
            f"{sig_sql('objective_fn')} AS objective_fn, {r6_sql('frac_reassigned')} AS frac_reassigned, "
            f"CAST(num_iterations AS BIGINT) AS num_iterations, "
            f"{r6_sql('simple_silhouette')} AS simple_silhouette FROM ({inner})")


def _points(spark, sf):
    return fx.f7_points(spark, sf)


@query("kmeans_random", lambda: _km_summary_sql(
    osql.kmeans_sql(fx.F7_SQL.replace("vec_id,", "vec_id AS id,"), [8], "random")))
def q_kmeans_random(spark, sf):
    return _km_summary(km.kmeans(_points(spark, sf), "vec_id", "x", 8, init="random"))


@query("kmeanspp", lambda: _km_summary_sql(
    osql.kmeans_sql(fx.F7_SQL.replace("vec_id,", "vec_id AS id,"), [8], "kmeanspp")))
def q_kmeanspp(spark, sf):
    return _km_summary(km.kmeans(_points(spark, sf), "vec_id", "x", 8, init="kmeanspp"))


_TEXT_ID_SQL = f"SELECT 'v' || CAST(vec_id AS VARCHAR) AS id, x FROM ({fx.F7_SQL})"


@query("kmeanspp_text_id", lambda: _km_summary_sql(osql.kmeans_sql(_TEXT_ID_SQL, [8], "kmeanspp")))
def q_kmeanspp_text_id(spark, sf):
    """D^2 seeding over ids that are text."""
    pts = _points(spark, sf).select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("name"), "x")
    return _km_summary(km.kmeans(pts, "name", "x", 8, init="kmeanspp", metric="madlib.squared_dist_norm2",
                                 aggregate="madlib.avg"))


_FIVE_SQL = ("SELECT o_orderkey AS id, [CAST(o_orderkey % 5 AS DOUBLE), CAST((o_orderkey % 5) * (o_orderkey % 5) "
             "AS DOUBLE)] AS x FROM orders")


def _sweep_small_sql() -> str:
    two = _km_summary_sql(osql.kmeans_sql(_FIVE_SQL, [2], "kmeanspp", max_iter=10))
    return f"""
    SELECT *, CAST(NULL AS VARCHAR) AS status FROM ({two})
    UNION ALL
    SELECT 6, NULL, NULL, NULL, NULL,
           'only ' || CAST(count(DISTINCT x) AS VARCHAR) || ' distinct points to seed K = 6' FROM ({_FIVE_SQL})"""


@query("kmeans_sweep_small", _sweep_small_sql)
def q_kmeans_sweep_small(spark, sf):
    """A sweep over points of five distinct places: K = 6 says why it has no model."""
    from sparkprep.sources.tables import read_table
    r = F.col("o_orderkey") % 5
    pts = read_table(spark, sf, "orders").select("o_orderkey", F.array(
        r.cast("double"), (r * r).cast("double")).alias("x"))
    out = km.kmeans_sweep(pts, "o_orderkey", "x", [2, 6], init="kmeanspp", max_iter=10)
    return _km_summary(out.filter("status IS NULL")).withColumn("status", F.lit(None).cast("string")).unionByName(
        out.filter("status IS NOT NULL").select(
            F.col("num_clusters").cast("long").alias("num_clusters"), "objective_fn", "frac_reassigned",
            F.col("num_iterations").cast("long").alias("num_iterations"), "simple_silhouette", "status"))


@query("kmeans_random_centroids", lambda: (
    "SELECT CAST(num_clusters AS BIGINT) AS num_clusters, CAST(cid AS BIGINT) AS cid, dim, "
    f"{r6_sql('value')} AS value FROM ("
    + osql.kmeans_sql(fx.F7_SQL.replace("vec_id,", "vec_id AS id,"), [8], "random", output="centroids")
    + ")"))
def q_kmeans_centroids(spark, sf):
    res = km.kmeans(_points(spark, sf), "vec_id", "x", 8, init="random")
    return (res.select("num_clusters", F.posexplode("centroids").alias("cid", "c"))
            .select(F.col("num_clusters").cast("long").alias("num_clusters"),
                    F.col("cid").cast("long").alias("cid"), F.posexplode("c").alias("p", "v"))
            .select("num_clusters", "cid", (F.col("p") + 1).cast("long").alias("dim"),
                    r6("v").alias("value")))


@query("kmeans_sweep", lambda: _km_summary_sql(
    osql.kmeans_sql(fx.F7_SQL.replace("vec_id,", "vec_id AS id,"), SWEEP_KS, "random")))
def q_kmeans_sweep(spark, sf):
    return _km_summary(km.kmeans_sweep(_points(spark, sf), "vec_id", "x", SWEEP_KS, init="random"))


def _compare_sql() -> str:
    pts = fx.F7_SQL.replace("vec_id,", "vec_id AS id,")
    a = _km_summary_sql(osql.kmeans_sql(pts, SWEEP_KS, "random"), f"'{C.ALGO_RANDOM}' AS algo_type, ")
    b = _km_summary_sql(osql.kmeans_sql(pts, SWEEP_KS, "kmeanspp"),
                        f"'{C.ALGO_KMEANSPP}' AS algo_type, ")
    return f"{a} UNION ALL {b}"


@query("kmeans_compare", _compare_sql)
def q_kmeans_compare(spark, sf):
    both = km.kmeans_sweeps(_points(spark, sf), "vec_id", "x", SWEEP_KS)
    out = km.kmeans_compare(both)
    return out.select("algo_type", F.col("num_clusters").cast("long").alias("num_clusters"),
                   sig("objective_fn").alias("objective_fn"),
                   r6("frac_reassigned").alias("frac_reassigned"),
                   F.col("num_iterations").cast("long").alias("num_iterations"),
                   r6("simple_silhouette").alias("simple_silhouette"))


def _best_sql() -> str:
    return (f"SELECT * FROM ({_compare_sql()}) ORDER BY simple_silhouette DESC NULLS FIRST, "
            f"algo_type, num_clusters LIMIT 1")


@query("kmeans_best", _best_sql)
def q_kmeans_best(spark, sf):
    both = km.kmeans_sweeps(_points(spark, sf), "vec_id", "x", SWEEP_KS)
    out = km.kmeans_compare(both, best=True)
    return out.select("algo_type", F.col("num_clusters").cast("long").alias("num_clusters"),
                      sig("objective_fn").alias("objective_fn"),
                      r6("frac_reassigned").alias("frac_reassigned"),
                      F.col("num_iterations").cast("long").alias("num_iterations"),
                      r6("simple_silhouette").alias("simple_silhouette"))


def _seed_model(points, k: int, seed: int = 42):
    """One row ``num_clusters, centroids``: the k points with the smallest hash."""
    top = (points.select("x", hash_uniform("vec_id", seed=seed).alias("u"), "vec_id")
           .orderBy("u", "vec_id").limit(k))
    return top.agg(F.transform(F.sort_array(F.collect_list(F.struct("u", "vec_id", "x"))),
                               lambda s: s["x"]).alias("centroids")).select(
        F.lit(k).alias("num_clusters"), "centroids")


def _seed_sql(k: int) -> str:
    u = hash_uniform_sql("vec_id", seed=42)
    return (f"SELECT CAST(row_number() OVER (ORDER BY u, vec_id) - 1 AS INTEGER) AS cid, x FROM "
            f"(SELECT vec_id, x, {u} AS u FROM ({fx.F7_SQL}) ORDER BY u, vec_id LIMIT {k})")


def _closest_sql() -> str:
    return f"""
    WITH s AS ({_seed_sql(8)}),
    dd AS (SELECT p.vec_id, list_sort(list(struct_pack(d := {osql._d2('p.x', 's.x')}, i := s.cid))) AS ds
           FROM ({fx.F7_SQL}) p, s GROUP BY p.vec_id)
    SELECT vec_id, CAST(ds[1].i AS BIGINT) AS id1, CAST(ds[2].i AS BIGINT) AS id2,
           {r6_sql('ds[1].d')} AS d1, {r6_sql('ds[2].d')} AS d2 FROM dd"""


@query("closest_columns", _closest_sql)
def q_closest(spark, sf):
    pts = _points(spark, sf)
    (_, cents), = km.bounded_models(_seed_model(pts, 8))
    lit_c = km.models_column([(8, cents)])[0]["centroids"]
    out = pts.select("vec_id", closest_columns(lit_c, F.col("x"), 2).alias("r"))
    return out.select("vec_id", F.col("r.column_ids")[0].cast("long").alias("id1"),
                      F.col("r.column_ids")[1].cast("long").alias("id2"),
                      r6(F.col("r.distances")[0]).alias("d1"), r6(F.col("r.distances")[1]).alias("d2"))


def _closest_tables_sql() -> str:
    parts = [f"""SELECT {k} AS num_clusters, vec_id, list_sort(list(struct_pack(d := {osql._d2('p.x', 's.x')}, i := s.cid)))
              AS ds FROM ({fx.F7_SQL}) p, ({_seed_sql(k)}) s GROUP BY p.vec_id""" for k in (3, 36)]
    return f"""
    SELECT CAST(num_clusters AS BIGINT) AS num_clusters, vec_id, CAST(g.i AS BIGINT) AS rank,
           CAST(ds[g.i].i AS BIGINT) AS column_id, {r6_sql('sqrt(ds[g.i].d)')} AS distance
    FROM ({' UNION ALL '.join(parts)}), range(1, 4) g(i)"""


@query("closest_model_tables", _closest_tables_sql)
def q_closest_tables(spark, sf):
    """The three nearest centroids of every model of a table, as distances."""
    pts = _points(spark, sf)
    models = _seed_model(pts, 3).unionByName(_seed_model(pts, 36))
    out = km.closest_to(pts.select("vec_id", "x"), "x", models, m=3, metric="dist_norm2")
    each = out.select("vec_id", F.explode("closest").alias("c"))
    pair = F.arrays_zip(F.col("c.column_ids").alias("i"), F.col("c.distances").alias("d"))
    return (each.select(F.col("c.num_clusters").cast("long").alias("num_clusters"), "vec_id",
                        F.posexplode(pair).alias("rank", "p"))
            .select("num_clusters", "vec_id", (F.col("rank") + 1).cast("long").alias("rank"),
                    F.col("p.i").cast("long").alias("column_id"), r6("p.d").alias("distance")))


def _silhouette_sql() -> str:
    parts = []
    for k in (4, 8):
        parts.append(f"""SELECT {k} AS num_clusters, avg(CASE WHEN ds[2] = 0 THEN 0.0
              ELSE (ds[2] - ds[1]) / ds[2] END) AS sil FROM (
            SELECT p.vec_id, list_sort(list({osql._d2('p.x', 's.x')})) AS ds
            FROM ({fx.F7_SQL}) p, ({_seed_sql(k)}) s GROUP BY p.vec_id)""")
    return (f"SELECT CAST(num_clusters AS BIGINT) AS num_clusters, {r6_sql('sil')} AS simple_silhouette "
            f"FROM ({' UNION ALL '.join(parts)})")


@query("simple_silhouette", _silhouette_sql)
def q_silhouette(spark, sf):
    pts = _points(spark, sf)
    models = _seed_model(pts, 4).unionByName(_seed_model(pts, 8))
    out = km.simple_silhouette(pts, "x", models)
    return out.select(F.col("num_clusters").cast("long").alias("num_clusters"),
                      r6("simple_silhouette").alias("simple_silhouette"))


# ------------------------------------------------- array groups, synthetic data


def _concat_sql() -> str:
    return f"""
    WITH f AS ({fx.F10_SQL}),
    o AS (SELECT key, ord, arr, coalesce(sum(len(arr)) OVER (PARTITION BY key ORDER BY ord
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
          FROM f WHERE arr IS NOT NULL),
    el AS (SELECT key, start + i AS pos, arr[i] AS value
           FROM (SELECT key, start, arr, unnest(generate_series(1, len(arr))) AS i FROM o))
    SELECT key, CAST(pos AS BIGINT) AS pos, {r6_sql('value')} AS value FROM el
    UNION ALL
    SELECT key, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) FROM f GROUP BY key
    HAVING coalesce(sum(len(arr)), 0) = 0"""


@query("array_concat_agg", _concat_sql)
def q_concat(spark, sf):
    out = arr_ops.array_concat_agg(fx.f10_orders(spark, sf), "key", "ord", "arr")
    return explode_vector(out, ["key"], {"value": "arr"}, round_cols={"value": r6}, outer=True) \
        .select("key", F.when(F.col("value").isNull(), F.lit(None)).otherwise(F.col("pos"))
                .cast("long").alias("pos"), "value")


@query("array_concat_agg_long", _concat_sql)
def q_concat_long(spark, sf):
    out = arr_ops.array_concat_agg(fx.f10_orders(spark, sf), "key", "ord", "arr", layout="long")
    return out.select("key", F.col("pos").cast("long").alias("pos"), r6("value").alias("value"))


@query("array_group_size", lambda: (
    f"SELECT key, CAST(sum(len(arr)) AS BIGINT) AS n_elements, "
    f"'{C.GROUP_SIZE_PREFIX}' || CAST(CAST(sum(len(arr)) AS BIGINT) AS VARCHAR) AS result "
    f"FROM ({fx.F10_SQL}) GROUP BY key"))
def q_group_size(spark, sf):
    return arr_ops.array_group_size(fx.f10_orders(spark, sf), "key", "arr")


def _running_sql() -> str:
    return f"""
    WITH f AS ({fx.F10_SQL}),
    c AS (SELECT key, ord, CAST(sum(coalesce(len(arr), 0)) OVER (PARTITION BY key ORDER BY ord
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n_elements,
              ord = max(ord) OVER (PARTITION BY key) AS last FROM f)
    SELECT key, ord, n_elements, round(n_elements * 8.0 / 1048576.0, 6) AS size_mb,
           CASE WHEN last THEN '{C.ACCUMULATE_DONE_PREFIX}'
                    || printf('%.6f', round(n_elements * 8.0 / 1048576.0, 6))
                    || '{C.ACCUMULATE_DONE_SUFFIX}'
                ELSE '{C.ACCUMULATE_PENDING}' END AS result
    FROM c"""


@query("running_accumulate", _running_sql)
def q_running(spark, sf):
    return arr_ops.running_accumulate(fx.f10_orders(spark, sf), "key", "ord", "arr")


@query("gram_matrix_wide", lambda: (
    "SELECT i, j, count(*) AS n, " + r6_sql("sum(v[i])") + " AS sum_i, " + r6_sql("sum(v[i] * v[j])") + " AS xtx "
    "FROM (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings), range(1, 65) a(i), range(1, 65) b(j) "
    "GROUP BY i, j"))
def q_gram_wide(spark, sf):
    """All 64 variables of the embeddings, beyond what generated code aggregates."""
    from sparkprep.sources.tables import read_table
    g = gram_ops.gram_matrix(read_table(spark, sf, "embeddings"), "embedding", p=64)
    return g.select("i", "j", "n", r6("sum_i").alias("sum_i"), r6("xtx").alias("xtx"))


@query("running_totals_ts", lambda: (
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CAST(sum(event_id % 7) OVER (PARTITION BY CAST(ts AS DATE) "
    "ORDER BY event_id) AS BIGINT) AS total, event_id = max(event_id) OVER (PARTITION BY CAST(ts AS DATE)) AS final "
    "FROM events"))
def q_running_ts(spark, sf):
    """Few timestamp keys, each over several partitions."""
    from sparkprep.operators.ordered import running_totals
    from sparkprep.sources.tables import read_table
    events = read_table(spark, sf, "events").select(
        "event_id", F.to_date("ts").cast("timestamp").alias("day"), (F.col("event_id") % 7).alias("v"))
    out = running_totals(events, "day", ["event_id"], "v", out="total", last_flag="final", num_partitions=9)
    return out.select("event_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "total", "final")


@query("synth_uniform", lambda: (
    f"SELECT p_partkey AS id, {r6_sql(hash_uniform_sql('p_partkey', '1'))} AS x, "
    f"{r6_sql(hash_uniform_sql('p_partkey', '2'))} AS y FROM part"))
def q_synth_uniform(spark, sf):
    from sparkprep.sources.tables import read_table
    ids = read_table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    out = synth.synth_uniform(ids, id_col="id")
    return out.select("id", r6("x").alias("x"), r6("y").alias("y"))


@query("synth_array", lambda: (
    f"SELECT p_partkey AS id, CAST(i AS BIGINT) AS pos, "
    f"{r6_sql(hash_uniform_sql('p_partkey', 'i'))} AS value FROM part, range(1, p_size + 1) t(i)"))
def q_synth_array(spark, sf):
    from sparkprep.sources.tables import read_table
    base = read_table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size")
    out = synth.synth_array(base, "p_size", id_col="id")
    return explode_vector(out, ["id"], {"value": "arr"}, round_cols={"value": r6})


def _replicated_sql() -> str:
    u = hash_uniform_sql("id", "model", "rep")
    return f"""SELECT model, row_number() OVER (PARTITION BY model ORDER BY u, id, rep) AS row_indx,
        features, quality FROM (SELECT b.*, m.model, r.rep, {u} AS u
        FROM ({fx.F11_SQL}) b, range(1, 4) m(model), range(1, 6) r(rep))"""


@query("replicate_shuffle", lambda: f"""
    SELECT CAST(model AS BIGINT) AS model, CAST(row_indx AS BIGINT) AS row_indx,
           CAST(i AS BIGINT) AS pos, {r6_sql('features[i]')} AS value, {r6_sql('quality')} AS quality
    FROM ({_replicated_sql()}), range(1, 4) t(i)""")
def q_replicate(spark, sf):
    rep = synth.replicate_shuffle(fx.f11_base(spark, sf), "id", 3, 5)
    out = explode_vector(rep, ["model", "row_indx", "quality"], {"value": "features"},
                         round_cols={"value": r6})
    return out.select(F.col("model").cast("long").alias("model"), "row_indx", "pos", "value",
                      r6("quality").alias("quality"))


def _ridge_rows_sql() -> str:
    inner = osql.ridge_sql(f"SELECT * FROM ({_replicated_sql()})", "model",
                           ["features[1]", "features[2]", "features[3]"], "quality", 0.5)
    out = _ridge_sql_out(inner, "model")
    return f"""SELECT CAST(r.model AS BIGINT) AS model, f.final_row AS current_row, f.final_row,
        r.idx, r.coef, r.intercept, r.r_square FROM ({out}) r
        JOIN (SELECT model, CAST(max(row_indx) AS BIGINT) AS final_row FROM ({_replicated_sql()})
              GROUP BY model) f ON f.model = r.model"""


@query("ridge_by_group_rows", _ridge_rows_sql)
def q_ridge_rows(spark, sf):
    rep = synth.replicate_shuffle(fx.f11_base(spark, sf), "id", 3, 5)
    out = linear.ridge_by_group_rows(rep, "model", "row_indx", "features", "quality", 0.5, p=3)
    return _ridge_out(out.withColumn("model", F.col("model").cast("long")), "model",
                      extra=("current_row", "final_row"))


@query("matrix_size_report", lambda: (
    f"SELECT label, CAST(count(*) AS BIGINT) AS n_rows, CAST(max(len(embedding)) AS BIGINT) AS n_cols, "
    f"CAST(sum(len(embedding)) * 8 AS BIGINT) AS size_bytes, "
    f"{format_bytes_sql('sum(len(embedding)) * 8')} AS size_pretty FROM embeddings GROUP BY label"))
def q_matrix_size(spark, sf):
    from sparkprep.sources.tables import read_table
    return report.matrix_size_report(read_table(spark, sf, "embeddings"), "label", "embedding")


@query("table_size_report")
def q_table_size(spark, sf):
    names = ["lineitem", "orders", "part", "embeddings"]
    return report.table_size_report(spark, {n: f"{sf.rstrip('/')}/{n}.parquet" for n in names})


# ------------------------------------------------------------------ flagship
def _flagship_sql() -> str:
    from sparkprep.plans.flagship import flagship_sql
    return flagship_sql()


@query("flagship", _flagship_sql)
def q_flagship(spark, sf):
    from sparkprep.plans.flagship import flagship
    out = flagship(spark, sf)
    return out.select("algo_type", F.col("num_clusters").cast("long").alias("num_clusters"),
                      sig("objective_fn").alias("objective_fn"),
                      r6("frac_reassigned").alias("frac_reassigned"),
                      F.col("num_iterations").cast("long").alias("num_iterations"),
                      r6("simple_silhouette").alias("simple_silhouette"))
