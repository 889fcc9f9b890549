"""Unit tests for the reference's semantic traps, on tiny literal frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.functions.arrays import closest_columns, filter_array_at_index
from sparkprep.operators import arrays, impute, kmeans, linear, vif
from sparkprep.operators.schema import feature_columns


def test_feature_columns_orders_and_excludes(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 3)], "id int, b double, s string, a int")
    assert feature_columns(df, ["id"]) == ["a", "b"]
    assert feature_columns(df, [], order="ordinal") == ["id", "b", "a"]
    assert feature_columns(df, ()) == ["a", "b", "id"]


def test_stats_drop_zero_single_and_null_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, None, 1.0), (2, 1.0, 7.0, None, None)],
                               "id int, c double, v double, n double, one double")
    rows = {r["column_name"]: r for r in impute.column_stats(df, ["c", "v", "n", "one"]).collect()}
    assert set(rows) == {"v"}
    assert rows["v"]["avg"] == 6.0
    assert rows["v"]["stddev"] == pytest.approx(np.sqrt(2.0))


def test_vectors_keep_nulls_and_impute_to_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, None, 20.0), (3, 3.0, None)],
                               "id int, a double, b double")
    out = {r["id"]: r for r in impute.impute_normalize_vectors(df, "id").collect()}
    assert out[2]["feat_name_vect"] == ["a", "b"]
    assert out[2]["feat_vect"][0] is None
    assert out[2]["feat_vect_normalized"][0] == 0.0
    assert out[3]["feat_vect_normalized"][1] == 0.0


def test_constant_term_sorts_among_names(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 1.0)], "id int, zz double, aa double")
    r = impute.impute_normalize_vectors(df, "id", constant_term=True, unique_id=True).first()
    assert r["feat_name_vect"] == ["aa", "constant_term", "zz"]
    assert r["feat_vect"][1] == 1.0 and r["feat_vect_normalized"][1] == 1.0


def test_duplicate_ids_merge_by_name_then_value(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (1, None, 3.0), (2, 2.0, 2.0)],
                               "id int, a double, b double")
    r = {x["id"]: x for x in impute.impute_normalize_vectors(df, "id").collect()}[1]
    assert r["feat_name_vect"] == ["a", "a", "b", "b"]
    assert r["feat_vect"] == [None, 5.0, 1.0, 3.0]


def test_no_surviving_feature_gives_empty_vectors(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0)], "id int, c double")
    r = impute.impute_normalize_vectors(df, "id", unique_id=True).first()
    assert r["feat_name_vect"] == [] and r["feat_vect"] == []


def test_columns_form_filters_types_and_zero_variance(spark):
    df = spark.createDataFrame([(1, 1, 2, 1.0, 7.0), (2, 3, 2, 2.0, 7.0)],
                               "id int, i int, big bigint, d double, k double")
    out = impute.impute_normalize_columns(df, "id")
    assert out.columns == ["id", "d_normalized", "i_normalized"]


def test_normalised_columns_have_mean_zero_sd_one(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(5, 3, (200, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    out = impute.impute_normalize_columns(df, "id")
    st = out.agg(F.avg("a_normalized"), F.stddev("a_normalized")).first()
    assert st[0] == pytest.approx(0.0, abs=1e-12)
    assert st[1] == pytest.approx(1.0, abs=1e-12)


def test_filter_array_at_index_edges(spark):
    df = spark.createDataFrame([([1.0, None, 3.0],)], "a array<double>")
    r = df.select(*[filter_array_at_index("a", i).alias(f"i{i}") for i in (1, 2, 3, 4)]).first()
    assert r["i1"] == [None, 3.0]
    assert r["i2"] == [1.0, 3.0]
    assert r["i3"] == [1.0, None]
    assert r["i4"] == [1.0, None, 3.0]


def _vif_frame(spark, rows):
    return spark.createDataFrame(rows, "id int, x1 double, x2 double, x3 double")


def test_vif_perfect_collinearity_sentinel_and_first_tie(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), float(2 * a)) for i, (a, b) in enumerate(rng.normal(0, 1, (50, 2)))]
    res = vif.vif_select_columns(_vif_frame(spark, rows), "id", threshold=10.0, num_steps=5)
    assert res.history[0][1] == "x1" and res.history[0][2] == 1e100
    assert res.kept_names[-1] == "x3"


def test_vif_equality_at_threshold_records_false_but_drops(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(rng.normal(0, 1, (40, 3)))]
    df = _vif_frame(spark, rows)
    first = vif.vif_scores(df, ["x1", "x2", "x3"]).orderBy(F.desc("vif")).first()
    res = vif.vif_select_columns(df, "id", threshold=first["vif"], num_steps=1)
    assert res.history[0][3] is False
    assert first["feature"] not in res.kept_names


def test_vif_skips_constant_feature(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), 1.0) for i, (a, b) in enumerate(rng.normal(0, 1, (30, 2)))]
    sc = {r["feature"]: r["vif"] for r in vif.vif_scores(_vif_frame(spark, rows), ["x1", "x2", "x3"]).collect()}
    assert "x3" not in sc


def test_vif_names_must_agree(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1.0, 2.0]), (2, ["b", "a"], [1.0, 3.0]),
                                (3, ["a", "b"], [2.0, 1.0])],
                               "id int, n array<string>, f array<double>")
    with pytest.raises(ValueError):
        vif.vif_select_vectors(df, "id", "n", "f")


def test_linregr_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (100, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + rng.normal(0, 0.1, 100)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(100)],
                               "id int, f array<double>, y double")
    r = linear.linregr(df, "y", "f").first()
    coef, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert np.allclose(r["coef"], coef, atol=1e-10)


def test_ridge_matches_augmented_least_squares(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(3, 2, (120, 2))
    y = x @ np.array([0.7, -1.1]) + 4 + rng.normal(0, 0.2, 120)
    df = spark.createDataFrame([("g", x[i].tolist(), float(y[i])) for i in range(120)],
                               "k string, f array<double>, y double")
    r = linear.ridge_by_group(df, "k", "f", "y", alpha=0.5).first()
    xc, yc = x - x.mean(0), y - y.mean()
    a = np.vstack([xc, np.sqrt(0.5) * np.eye(2)])
    b = np.concatenate([yc, np.zeros(2)])
    w, *_ = np.linalg.lstsq(a, b, rcond=None)
    assert np.allclose(r["coef"], w, atol=1e-9)
    assert r["intercept"] == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-9)
    resid = y - (x @ w + r["intercept"])
    assert r["r_square"] == pytest.approx(1 - resid @ resid / (yc @ yc), abs=1e-9)


def test_kmeans_k1_silhouette_null_and_empty_cluster_keeps_centroid(spark):
    pts = [(i, [float(i % 2), 0.0]) for i in range(10)]
    df = spark.createDataFrame(pts, "id int, x array<double>")
    r = kmeans.kmeans_sweep(df, "id", "x", [1]).first()
    assert r["simple_silhouette"] is None and r["num_clusters"] == 1
    assert r["centroids"] == [[0.5, 0.0]]
    # duplicate points as seeds: the second cluster stays empty and keeps its seed
    df2 = spark.createDataFrame([(1, [0.0]), (2, [0.0]), (3, [0.0])], "id int, x array<double>")
    r2 = kmeans.kmeans_sweep(df2, "id", "x", [2]).first()
    assert sorted(r2["centroids"]) == [[0.0], [0.0]]


def test_kmeans_invariant_to_partitioning(spark):
    rng = np.random.default_rng(6)
    pts = [(i, rng.normal(i % 3, 0.3, 4).tolist()) for i in range(300)]
    df = spark.createDataFrame(pts, "id int, x array<double>")
    a = kmeans.kmeans_sweep(df.repartition(1), "id", "x", [2, 3], init="kmeanspp").collect()
    b = kmeans.kmeans_sweep(df.repartition(7), "id", "x", [2, 3], init="kmeanspp").collect()
    for ra, rb in zip(a, b):
        assert ra["num_iterations"] == rb["num_iterations"]
        assert np.allclose(ra["centroids"], rb["centroids"], atol=1e-12)
        assert ra["simple_silhouette"] == pytest.approx(rb["simple_silhouette"], abs=1e-12)


def test_kmeans_objective_never_increases(spark):
    rng = np.random.default_rng(7)
    pts = [(i, rng.normal(0, 1, 3).tolist()) for i in range(200)]
    df = spark.createDataFrame(pts, "id int, x array<double>")
    objs = [kmeans.kmeans_sweep(df, "id", "x", [4], max_iter=t).first()["objective_fn"]
            for t in (1, 2, 3, 5)]
    assert all(b <= a + 1e-9 for a, b in zip(objs, objs[1:]))


def test_closest_columns_orders_distances(spark):
    df = spark.createDataFrame([([0.0, 0.0],)], "x array<double>")
    c = F.array(F.array(F.lit(3.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0)),
                F.array(F.lit(2.0), F.lit(0.0)))
    r = df.select(closest_columns(c, F.col("x"), 2).alias("r")).first()["r"]
    assert r["column_ids"] == [1, 2] and r["distances"] == [1.0, 4.0]


def test_concat_agg_skips_nulls_and_all_null_group(spark):
    df = spark.createDataFrame([(1, 2, [3.0]), (1, 1, [1.0, 2.0]), (1, 3, None), (2, 1, None)],
                               "k int, o int, a array<double>")
    got = {r["k"]: r["arr"] for r in arrays.array_concat_agg(df, "k", "o", "a").collect()}
    assert got == {1: [1.0, 2.0, 3.0], 2: None}
    longf = {(r["k"], r["pos"]): r["value"] for r in
             arrays.array_concat_agg(df, "k", "o", "a", layout="long").collect()}
    assert longf == {(1, 1): 1.0, (1, 2): 2.0, (1, 3): 3.0, (2, None): None}
    sizes = {r["k"]: r["result"] for r in arrays.array_group_size(df, "k", "a").collect()}
    assert sizes == {1: "size of x:3", 2: None}


def test_running_accumulate_reports_at_final_value(spark):
    df = spark.createDataFrame([(1, y, [0.0] * 131072) for y in (1, 2, 3)],
                               "row int, y int, arr array<double>")
    out = {r["y"]: r["result"] for r in arrays.running_accumulate(df, "row", "y", "arr", 3).collect()}
    assert out == {1: "Processing...", 2: "Processing...", 3: "Size: 3.000000 MB"}


def test_batched_seeding_equals_one_round_per_job(spark):
    rng = np.random.default_rng(8)
    pts = [(i, rng.normal(i % 4, 0.5, 3).tolist()) for i in range(400)]
    p = kmeans.prepare_points(spark.createDataFrame(pts, "id long, x array<double>").repartition(4),
                              "id", "x").cache()
    one = kmeans.seed_kmeanspp(p, 12, rounds_per_job=1)
    for per_job, m in ((5, 1), (12, 3), (12, 64)):
        assert np.array_equal(kmeans.seed_kmeanspp(p, 12, rounds_per_job=per_job, candidates=m), one)


def test_empty_inputs_give_empty_results_or_clear_errors(spark):
    from sparkprep.operators import gram, synth
    from sparkprep.operators.ordered import running_totals
    wide = spark.createDataFrame([], "id long, a double, b int, label int")
    vec = spark.createDataFrame([], "id long, n array<string>, f array<double>, y double, k string, r long")
    arr = spark.createDataFrame([], "k long, o long, a array<double>")
    assert impute.column_stats(wide, ["a", "b"]).count() == 0
    assert impute.impute_normalize_vectors(wide, "id", label_col="label", constant_term=True).count() == 0
    assert impute.impute_normalize_vectors(wide, "id", layout="long").count() == 0
    assert impute.impute_normalize_columns(wide, "id").count() == 0
    assert gram.gram_matrix(wide, ["a", "b"]).filter("n > 0").count() == 0
    assert linear.linregr(wide, "a", ["b"]).first()["num_rows"] == 0
    assert vif.vif_scores(wide, ["a", "b"]).count() == 0
    assert vif.vif_select_columns(wide, "id").steps.count() == 0
    assert vif.vif_select_vectors(vec, "id", "n", "f").steps.count() == 0
    assert linear.ridge_by_group(vec, "k", "f", "y", p=2).count() == 0
    assert linear.ridge_by_group_rows(vec, "k", "r", "f", "y", p=2).count() == 0
    with pytest.raises(ValueError):
        kmeans.kmeans(vec, "id", "f", 2)
    assert arrays.array_concat_agg(arr, "k", "o", "a").count() == 0
    assert arrays.array_concat_agg(arr, "k", "o", "a", layout="long").count() == 0
    assert arrays.running_accumulate(arr, "k", "o", "a").count() == 0
    assert running_totals(arr, "k", ["o"], F.lit(1)).count() == 0
    empty_base = spark.createDataFrame([], "id long, features array<float>, quality float")
    assert synth.replicate_shuffle(empty_base, "id", 2, 2).count() == 0


def test_each_k_of_a_sweep_stands_for_itself(spark):
    df = spark.createDataFrame([(i, [float(i % 5)]) for i in range(9)], "id long, x array<double>")
    rows = {(r["algo_type"], r["num_clusters"]): r for r in kmeans.kmeans_sweeps(df, "id", "x", [2, 6, 12]).collect()}
    assert len(rows) == 6 and rows["kmeans++", 2]["status"] is None and rows["kmeans_random", 6]["status"] is None
    assert "distinct" in rows["kmeans++", 6]["status"] and "exceeds" in rows["kmeans++", 12]["status"]
    assert "exceeds" in rows["kmeans_random", 12]["status"]
    for r in rows.values():
        assert (r["centroids"] is None) == (r["status"] is not None) == (r["num_iterations"] is None)
    best = kmeans.kmeans_compare(kmeans.kmeans_sweeps(df, "id", "x", [2, 12]), best=True).first()
    assert best["num_clusters"] == 2


def test_ridge_keys_with_odd_names_and_nulls(spark):
    rows = [(None if i % 4 == 0 else i % 2, [float(i), float(i % 3)], float(2 * i + 1)) for i in range(40)]
    df = spark.createDataFrame(rows, "`model id` long, f array<double>, y double")
    out = {r["model id"]: r for r in linear.ridge_by_group(df, "model id", "f", "y").collect()}
    assert set(out) == {None, 0, 1}
    assert all(len(r["coef"]) == 2 for r in out.values())
