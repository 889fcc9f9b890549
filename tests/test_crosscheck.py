"""Cross-checks against pyspark.ml on the given tables."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from sparkprep.operators import kmeans, linear, vif
from sparkprep.sources import fixtures as fx
from tests.conftest import SF_MID


def test_linregr_matches_spark_ml_without_intercept(spark):
    df = fx.f3_collinear(spark, SF_MID)
    ours = linear.linregr(df, "x3", ["x1", "x2", "x4"]).first()
    va = VectorAssembler(inputCols=["x1", "x2", "x4"], outputCol="v")
    ml = LinearRegression(featuresCol="v", labelCol="x3", fitIntercept=False, regParam=0.0,
                          solver="normal", standardization=False).fit(va.transform(df))
    assert np.allclose(ours["coef"], ml.coefficients.toArray(), rtol=1e-8, atol=1e-10)


def test_vif_with_intercept_equals_inverse_correlation_diagonal(spark):
    df = fx.f3_collinear(spark, SF_MID)
    got = {r["feature"]: r["vif"] for r in
           vif.vif_scores(df, ["x1", "x2", "x3", "x4"], intercept=True).collect()}
    x = np.array(df.select("x1", "x2", "x3", "x4").collect(), dtype=np.float64)
    inv = np.linalg.inv(np.corrcoef(x, rowvar=False))
    for j, name in enumerate(["x1", "x2", "x3", "x4"]):
        assert got[name] == pytest.approx(inv[j, j], rel=1e-8)
        assert got[name] >= 1.0 - 1e-12


def test_kmeans_objective_close_to_spark_ml(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    pts = fx.f7_points(spark, SF_MID)
    ours = kmeans.kmeans_sweep(pts, "vec_id", "x", [8], init="kmeanspp").first()
    ml = KMeans(k=8, seed=42, maxIter=60, featuresCol="v").fit(
        pts.select(array_to_vector("x").alias("v")))
    ml_cost = ml.summary.trainingCost
    # different seeding and stopping rules: same order of magnitude of fit
    assert 0.8 * ml_cost < ours["objective_fn"] < 1.25 * ml_cost


def test_vif_with_intercept_matches_spark_ml_correlation(spark):
    from pyspark.ml.stat import Correlation
    df = fx.f3_collinear(spark, SF_MID)
    va = VectorAssembler(inputCols=["x1", "x2", "x3", "x4"], outputCol="v")
    corr = Correlation.corr(va.transform(df), "v").first()[0].toArray()
    inv = np.linalg.inv(corr)
    got = {r["feature"]: r["vif"] for r in
           vif.vif_scores(df, ["x1", "x2", "x3", "x4"], intercept=True).collect()}
    for j, name in enumerate(["x1", "x2", "x3", "x4"]):
        assert got[name] == pytest.approx(inv[j, j], rel=1e-8)
