"""Skew-proof and layout-independent paths."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkprep.operators.ordered import running_totals
from sparkprep.operators import synth
from sparkprep.streaming import normalize_stream
from sparkprep.operators import impute


def _expected(df):
    w = W.partitionBy("k").orderBy("o")
    return (df.withColumn("cum", F.sum(F.coalesce("v", F.lit(0))).over(
        w.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("last", F.col("o") == F.max("o").over(W.partitionBy("k"))))


def test_running_totals_hot_key_small_batches(spark):
    random.seed(11)
    rows = [("hot" if random.random() < 0.5 else random.choice(["a", "b", None]), i,
             random.choice([1, 2, None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = running_totals(df, "k", ["o"], "v", "cum", last_flag="last", num_partitions=9)
        a = sorted(map(tuple, got.select("k", "o", "v", "cum", "last").collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    b = sorted(map(tuple, _expected(df).select("k", "o", "v", "cum", "last").collect()), key=repr)
    assert a == b
    parts = got.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.when(F.col("k") == "hot", 1)).alias("h"))
    assert parts.filter(F.col("h") > 0).count() > 1  # the hot key spans several tasks


def test_replicate_shuffle_numbers_each_model_fully(spark):
    base = spark.createDataFrame([(i, [float(i)], float(i)) for i in range(1, 21)],
                                 "id long, features array<float>, quality float")
    rep = synth.replicate_shuffle(base, "id", 2, 3)
    st = rep.groupBy("model").agg(F.count("*").alias("n"), F.min("row_indx").alias("lo"),
                                  F.max("row_indx").alias("hi"),
                                  F.countDistinct("row_indx").alias("d")).collect()
    assert sorted((r["model"], r["n"], r["lo"], r["hi"], r["d"]) for r in st) == \
        [(1, 60, 1, 60, 60), (2, 60, 1, 60, 60)]


def test_synth_long_layout_matches_array_layout(spark):
    a = synth.synth_array(spark, 50, n_rows=3, layout="array")
    ex = a.select("y", F.posexplode("arr").alias("p", "value")).select(
        "y", (F.col("p") + 1).alias("pos"), "value")
    lg = synth.synth_array(spark, 50, n_rows=3, layout="long").select("y", "pos", "value")
    assert sorted(map(tuple, ex.collect())) == sorted(map(tuple, lg.collect()))


def test_normalize_stream(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), None if i % 3 == 0 else float(2 * i)) for i in range(30)],
                               "id int, a double, b double")
    src = str(tmp_path / "src")
    df.write.parquet(src)
    stats = impute.surviving_features(df, ["a", "b"])
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = (normalize_stream(stream, stats, "id").writeStream.format("memory")
         .queryName("norm_out").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.sql("SELECT * FROM norm_out").collect()))
    exp = sorted(map(tuple, impute.apply_normalization(df, stats, "id").collect()))
    assert got == exp


def test_wide_gram_arrow_path_matches_aggregates(spark):
    import numpy as np
    from sparkprep.operators import gram
    rng = np.random.default_rng(0)
    p = gram.WIDE_P + 3
    rows = [("a" if i % 3 else "b", rng.normal(100, 2, p).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, f array<double>").repartition(3)
    xs = gram.vector_elements("f", p)
    wide = {r["k"]: r for r in gram.gram_stats(df, xs, by=["k"]).collect()}
    old = gram.WIDE_P
    gram.WIDE_P = 10_000
    try:
        narrow = {r["k"]: r for r in gram.gram_stats(df, xs, by=["k"]).collect()}
    finally:
        gram.WIDE_P = old
    for k in ("a", "b"):
        assert wide[k]["n"] == narrow[k]["n"]
        assert np.allclose(wide[k]["means"], narrow[k]["means"], atol=1e-12)
        assert np.allclose(wide[k]["cov"], narrow[k]["cov"], atol=1e-10)


def test_results_unchanged_under_repartitioning(spark):
    from sparkprep.operators import linear
    from sparkprep.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    df = fx.f1_wide(spark, SF_SMALL, dup_ids=True)

    def vec(d):
        out = impute.impute_normalize_vectors(d, "id", exclude=["year"], label_col="label",
                                              constant_term=True)
        return sorted((r["id"], r["label"], tuple(r["feat_name_vect"]),
                       tuple(round(v, 9) for v in r["feat_vect_normalized"])) for r in out.collect())
    assert vec(df.repartition(1)) == vec(df.repartition(16))
    li = fx.f9_lineitem(spark, SF_SMALL)

    def ridge(d):
        return sorted((r["model"], tuple(round(c, 6) for c in r["coef"]), round(r["intercept"], 6))
                      for r in linear.ridge_by_group(d, "model", "features", "label", p=3).collect())
    assert ridge(li.repartition(1)) == ridge(li.repartition(16))
    base = fx.f10_orders(spark, SF_SMALL)

    def scan(d):
        return sorted(map(tuple, running_totals(d, "key", ["ord"], F.size("arr"), "cum")
                          .select("key", "ord", "cum").collect()))
    assert scan(base.repartition(1)) == scan(base.repartition(16))


def test_queries_identical_without_ansi_mode(spark):
    from sparkprep.plans.registry import QUERIES
    from tests.conftest import SF_SMALL
    keys = ["running_accumulate", "array_concat_agg_long", "array_concat_agg", "array_group_size",
            "matrix_size_report", "impute_normalize_vectors"]
    ansi = {k: sorted(map(repr, QUERIES[k](spark, SF_SMALL).collect())) for k in keys}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = {k: sorted(map(repr, QUERIES[k](spark, SF_SMALL).collect())) for k in keys}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    for k in keys:
        assert ansi[k] == legacy[k], k


def test_long_vectors_equal_exploded_vectors_with_a_hot_id(spark):
    import random
    random.seed(5)
    rows = [(0 if random.random() < 0.4 else random.randint(1, 50), random.randint(0, 1),
             random.choice([None, 1.0, 2.0, 3.5]), random.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "id int, label int, a double, b double")
    vec = impute.impute_normalize_vectors(df, "id", label_col="label", constant_term=True)
    ex = vec.select("id", "label", F.posexplode(F.arrays_zip("feat_name_vect", "feat_vect",
                                                               "feat_vect_normalized")))
    a = sorted((r["id"], r["label"], r["pos"] + 1, r["col"][0], r["col"][1], r["col"][2])
               for r in ex.collect())
    lg = impute.impute_normalize_vectors(df, "id", label_col="label", constant_term=True,
                                         layout="long")
    b = sorted((r["id"], r["label"], r["pos"], r["feat_name"], r["feat"], r["feat_normalized"])
               for r in lg.collect())
    assert a == b


def test_wide_vif_and_ridge_rows_use_arrow_path(spark):
    import numpy as np
    from sparkprep.operators import gram, linear, vif
    rng = np.random.default_rng(9)
    p = gram.WIDE_P + 2
    x = rng.normal(0, 1, (400, p))
    x[:, 1] = 2 * x[:, 0] + rng.normal(0, 0.01, 400)
    names = [f"c{i:02d}" for i in range(p)]
    rows = [(i, names, x[i].tolist(), float(x[i, :3].sum()), "g" if i % 2 else "h", i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "id int, n array<string>, f array<double>, y double, "
                                     "k string, r int")
    res = vif.vif_select_vectors(df, "id", "n", "f", threshold=10.0, num_steps=2)
    assert res.history[0][1] in ("c00", "c01") and res.history[0][2] > 100
    old = gram.WIDE_P
    gram.WIDE_P = 10_000
    try:
        narrow = vif.vif_select_vectors(df, "id", "n", "f", threshold=10.0, num_steps=2).history
        narrow_ridge = {r["k"]: r for r in linear.ridge_by_group_rows(df, "k", "r", "f", "y").collect()}
    finally:
        gram.WIDE_P = old
    for a, b in zip(res.history, narrow):
        assert a[1] == b[1] and abs(a[2] - b[2]) <= 1e-8 * b[2]
    wide_ridge = {r["k"]: r for r in linear.ridge_by_group_rows(df, "k", "r", "f", "y").collect()}
    for k in ("g", "h"):
        assert wide_ridge[k]["final_row"] == narrow_ridge[k]["final_row"]
        assert np.allclose(wide_ridge[k]["coef"], narrow_ridge[k]["coef"], atol=1e-9)


def _points_100(spark, n=4000, d=6):
    import numpy as np
    rng = np.random.default_rng(10)
    return spark.createDataFrame([(i, (rng.normal(0, 1, d) * 10.0 ** rng.integers(-3, 4, d)).tolist())
                                  for i in range(n)], "id long, x array<double>")


def test_kmeans_has_the_same_bits_for_any_partitioning(spark):
    from sparkprep.operators import kmeans as km
    df = _points_100(spark, 1000)
    runs = [km.kmeans_sweeps(df.repartition(parts), "id", "x", [2, 4], max_iter=2).collect()
            for parts in (1, 7, 100)]
    assert runs[0] == runs[1] == runs[2]  # centroids, objective and silhouette: exact equality


def test_tree_combines_at_most_fan_partials(spark, monkeypatch):
    import numpy as np
    from sparkprep.operators import kmeans as km
    from sparkprep.operators import reduction
    pts = km.prepare_points(_points_100(spark, 600), "id", "x").repartition(20, "id").cache()
    shape = km.shape_of(pts)
    models = [km._Model(k=4, c=km.seed_random(pts, 4))]
    models[0].prev = models[0].c + 0.05
    plain, scores = km._iteration(pts, models, shape)[0], km._final_pass(pts, models, shape)
    monkeypatch.setattr(reduction, "FAN", 3)  # four levels, the driver takes one row a cluster
    monkeypatch.setattr(reduction, "DRIVER_VALUES", 1)
    deep = km._iteration(pts, models, shape)[0]
    assert km._final_pass(pts, models, shape) == scores
    a, b = (sorted(rows, key=lambda r: r["c"]) for rows in (plain, deep))
    assert all(x["cnt"] == y["cnt"] and x["chg"] == y["chg"] and np.array_equal(x["s"], y["s"])
               for x, y in zip(a, b))
    exact = sum(np.array(r["x"]) for r in pts.collect())
    assert np.allclose(sum(r["s"] for r in a), exact, rtol=1e-12)


def test_kmeans_models_beyond_one_block(spark, monkeypatch, tmp_path):
    from sparkprep.operators import kmeans as km
    df = _points_100(spark, 500).coalesce(2)
    one = km.kmeans_sweep(df, "id", "x", [3, 7], max_iter=3).collect()
    monkeypatch.setattr(km, "BLOCK_BYTES", 5 * 6 * 8)  # five centroids a pass
    monkeypatch.setattr(km, "HELD_VALUES", 1)  # partial sums go on with every batch
    assert km.kmeans_sweep(df, "id", "x", [3, 7], max_iter=3).collect() == one


def test_kmeanspp_tournament_and_ids_of_any_type(spark, monkeypatch):
    import numpy as np
    from sparkprep.operators import kmeans as km
    from sparkprep.operators import reduction
    df = _points_100(spark, 400)
    for key in (F.col("id"), F.concat(F.lit("v"), "id"), F.timestamp_seconds("id"), F.struct("id", F.lit("a"))):
        p = km.prepare_points(df.withColumn("id", key).repartition(10), "id", "x").cache()
        one = km.seed_kmeanspp(p, 6, rounds_per_job=1)
        assert len(np.unique(one, axis=0)) == 6
        with monkeypatch.context() as m:
            m.setattr(reduction, "FAN", 3)
            m.setattr(reduction, "DRIVER_VALUES", 1)
            m.setattr(km, "BLOCK_BYTES", 2 * 6 * 8)  # distances carried from job to job
            assert np.array_equal(km.seed_kmeanspp(p, 6, candidates=4), one)


def test_model_tables_of_any_size(spark, monkeypatch):
    import time
    import numpy as np
    from sparkprep.functions.arrays import closest_columns
    from sparkprep.operators import kmeans as km
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)], "closest int, x array<double>")
    cents = [rng.normal(size=(k, 8)) for k in (1, 30, 30)]
    cents[2][11] = cents[2][3]  # equal centroids: the lower index first
    models = spark.createDataFrame([(len(c), c.tolist()) for c in cents], "num_clusters int, centroids array<array<double>>")
    want = {}
    for m, c in enumerate(cents):
        d2 = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        order = np.argsort(d2, axis=1, kind="stable")[:, :2]
        want[m] = (order, np.sqrt(np.take_along_axis(d2, order, axis=1)))

    def check():
        got = km.closest_to(df.withColumnRenamed("closest", "k"), "x", models, metric="madlib.dist_norm2").collect()
        assert len(got) == 201 and next(r for r in got if r["k"] == 900)["closest"] is None
        for r in got:
            for m, s in enumerate(r["closest"] or ()):
                assert s["column_ids"] == want[m][0][r["k"]].tolist()
                assert np.allclose(s["distances"], want[m][1][r["k"]])
        return [tuple(r) for r in km.simple_silhouette(df, "x", models).collect()]

    one = check()
    assert one[0] == (1, None) and one[1][0] == 30
    monkeypatch.setattr(km, "BLOCK_BYTES", 7 * 8 * 8)
    assert check() == one
    # a literal of 36,000 values plans at once
    wide = [(36, rng.normal(size=(36, 1000)).tolist())]
    t0 = time.time()
    out = spark.range(1).select(closest_columns(km.models_column(wide)[0]["centroids"],
                                                F.array_repeat(F.lit(0.0), 1000)).alias("r"))
    out._jdf.queryExecution().optimizedPlan()
    assert time.time() - t0 < 1.0
    assert out.first()["r"]["column_ids"][0] == int(np.argmin((np.array(wide[0][1]) ** 2).sum(axis=1)))


def test_metric_and_aggregate_names(spark):
    from sparkprep.operators import kmeans as km
    df = _points_100(spark, 60)
    a = km.kmeans(df, "id", "x", 3, metric="madlib.squared_dist_norm2", aggregate="madlib.avg").first()
    b = km.kmeans(df, "id", "x", 3, metric="dist_norm2").first()
    assert a["centroids"] == b["centroids"] and a["objective_fn"] != b["objective_fn"]
    for bad in ({"metric": "dist_norm1"}, {"aggregate": "median"}):
        with pytest.raises(ValueError, match="unknown"):
            km.kmeans(df, "id", "x", 3, **bad)


def test_equal_rows_of_one_id_spread_over_tasks(spark):
    n = 100_000
    df = spark.range(n).select(F.lit(7).alias("id"), (F.col("id") % 2).cast("double").alias("a"),
                               (F.col("id") * 0 + F.col("id") % 2).cast("double").alias("b"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = impute.impute_normalize_vectors(df, "id", layout="long")
        per = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in per) == 2 * n
    assert max(r["count"] for r in per) <= 2 * (2 * n / len(per)) and len(per) == 4
    edges = out.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()
    assert tuple(edges) == (1, 2 * n, 2 * n)
    order = [tuple(r) for r in out.groupBy("feat_name", "feat").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
             .orderBy("lo").collect()]
    assert order == [("a", 0.0, 1, n // 2), ("a", 1.0, n // 2 + 1, n), ("b", 0.0, n + 1, n + n // 2),
                     ("b", 1.0, n + n // 2 + 1, 2 * n)]


def test_keys_without_elements_come_from_the_scan(spark):
    from sparkprep.operators import arrays
    rows = [("a", 1, [1.0, None]), ("a", 2, None), ("a", 3, []), ("a", 4, [2.0]), ("b", 1, None), ("b", 2, []),
            (None, 1, []), ("c", 1, None)]
    df = spark.createDataFrame(rows, "k string, o int, x array<double>")
    out = arrays.array_concat_agg(df, "k", "o", "x", layout="long")
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([("a", 1, 1.0), ("a", 2, None), ("a", 3, 2.0), ("b", None, None), (None, None, None),
                          ("c", None, None)], key=str)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("RDD") == 1  # one scan, of the checkpoint


def test_split_is_exact_for_any_exponent_and_sums_do_not_depend_on_the_path(monkeypatch):
    from fractions import Fraction

    import numpy as np
    from sparkprep.operators import kmeans as km
    from sparkprep.operators import reduction

    rng = np.random.default_rng(8)
    for power in (-1060, -1000, -300, 0, 7, 300, 1010):
        x = np.ldexp(rng.standard_normal((50, 3)), power)
        exp = reduction.exponents(np.abs(x).max(axis=0))
        parts = reduction.split(x, exp)
        assert np.abs(parts).max() <= 1 << 24 and (parts == np.rint(parts)).all()
        for i, j in [(0, 0), (7, 1), (49, 2)]:
            whole = sum(int(parts[i, p * 3 + j]) << 24 * (2 - p) for p in range(3))
            grid = Fraction(2) ** (int(exp[j]) - 72)
            assert abs(Fraction(float(x[i, j])) - whole * grid) <= grid / 2
    x = rng.standard_normal((4_000, 5))
    parts = reduction.split(x, reduction.exponents(np.abs(x).max(axis=0)))
    a = rng.integers(0, 20, len(x))
    sums = []
    for limit in (0, 32):
        monkeypatch.setattr(km, "MATRIX_CLUSTERS", limit)
        held = km._Sums(0, 20, 15, 0)
        list(held.add(a, a % 2 == 0, parts))
        sums.append([v.tolist() for v in held.held])
    assert sums[0] == sums[1]


def test_kmeans_spreads_points_of_few_tasks_and_keeps_every_bit(spark, monkeypatch):
    from sparkprep.operators import kmeans as km
    df = _points_100(spark, 900).coalesce(1)
    plain = km.kmeans_sweeps(df, "id", "x", [2, 5], max_iter=4).collect()
    monkeypatch.setattr(km, "TASK_VALUES", 600)
    seen, lloyd = [], km._lloyd

    def watched(points, models, shape, *more):
        rows = points.groupBy(F.spark_partition_id().alias("pid")).count().collect()
        seen.append((shape.parts, sorted(r["count"] for r in rows)))
        return lloyd(points, models, shape, *more)

    monkeypatch.setattr(km, "_lloyd", watched)
    assert km.kmeans_sweeps(df, "id", "x", [2, 5], max_iter=4).collect() == plain
    parts, counts = seen[0]
    assert parts == len(counts) == km.CORE_TASKS * spark.sparkContext.defaultParallelism
    assert sum(counts) == 900 and counts[-1] <= 1.5 * 900 / parts
    km.kmeans_sweeps(df.repartition(30), "id", "x", [2], max_iter=1).collect()
    assert seen[1][0] == 30  # tasks enough: left as they are


def test_nearest_centroid_and_lead_on_both_paths(monkeypatch):
    import numpy as np
    from sparkprep.operators import kmeans as km

    rng = np.random.default_rng(21)
    for k, n in ((2, 1), (5, 9_000), (40, 5_000), (90, 700)):
        x, c = rng.normal(size=(n, 3)), rng.normal(size=(k, 3))
        c[k // 2] = c[0]  # equal centroids: the lower index
        d2 = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        lead = np.sort(np.sqrt(d2), axis=1)
        for limit in (0, 64, 1_000):
            monkeypatch.setattr(km, "LOOP_CLUSTERS", limit)
            a, margin = km._assign(x, c, with_margin=True)
            assert (a == d2.argmin(axis=1)).all() and (margin <= lead[:, 1] - lead[:, 0]).all()
            clear = lead[:, 1] - lead[:, 0] > 1e-3
            assert (margin[clear] > (lead[:, 1] - lead[:, 0])[clear] - 1e-4).all()
    # a point whose lead exceeds the threshold of its centroid had the same nearest one before
    prev = c + rng.normal(size=c.shape) * 0.02 * (np.arange(k)[:, None] == 7)
    moves = km._moves(c, prev)
    one = np.sqrt(((c - prev)[7] ** 2).sum())
    assert np.allclose(moves, one) and moves.shape == (k,)
    sure = margin > moves[a]
    assert sure.any() and (a[sure] == km._assign(x[sure], prev)).all()
