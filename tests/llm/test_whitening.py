"""Whitening against NumPy's dense eigensolver and exact whole-number arithmetic."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.llm import whitening
from sparkprep.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, n long, component string"


def brute(vectors, k=4):
    """values, vectors, trace, n, S of the distinct whole-number vectors."""
    x = np.array(sorted({tuple(math.floor(256 * float(c)) for c in v) for v in vectors}), dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    return e[::-1][:k], v[:, ::-1][:, :k], float(np.trace(cov)), n, s


def held(rows, vectors, ids, k=4):
    e, v, trace, n, s = brute(vectors, k)
    by = defaultdict(list)
    for r in rows:
        by[r["component"]].append(r)
    assert sorted(by) == list(range(1, min(k, len(e)) + 1)) and len(rows) == len(ids) * len(by)
    x = {i: np.array([math.floor(256 * float(c)) for c in vec], dtype=np.int64) for i, vec in zip(ids, vectors)}
    for c, got in by.items():
        want = {i: float(((n * a - s) / n) @ v[:, c - 1] / math.sqrt(e[c - 1])) for i, a in x.items()}
        sign = np.sign(sum(r["whitened"] * want[r["vec_id"]] for r in got))
        for r in got:
            a = n * x[r["vec_id"]] - s
            assert r["n"] == n and r["deviation"] == int((a * a).sum())
            assert abs(r["whitened"] - sign * want[r["vec_id"]]) < 1e-9
            assert abs(r["explained"] / (e[c - 1] / trace) - 1) < 1e-10 and r["identity_error"] < 1e-9


def test_given_table(spark):
    rows = QUERIES["op11_whitening"](spark, SF_SMALL).collect()
    given = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    held(rows, [r["embedding"] for r in given], [r["vec_id"] for r in given])


def test_odd_rows_over_many_partitions(spark):
    rng = np.random.default_rng(7)
    good = [(i, rng.normal(size=6).astype(np.float32).tolist(), 9, "x") for i in range(300)]
    good += [(300 + i, good[0][1], 9, "x") for i in range(100)]  # one vector a hundred times
    bad = [(900, None, 1, "y"), (901, [], 1, "y"), (902, [1.0, None] * 3, 1, "y"), (903, [float("nan")] * 6, 1, "y"),
           (904, [float("inf")] * 6, 1, "y"), (905, [1.0] * 5, 1, "y")]
    df = spark.createDataFrame(good + bad, SCHEMA).repartition(7)
    held(whitening.whitened(df).collect(), [r[1] for r in good], [r[0] for r in good])


def test_empty_single_and_without_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (None, [1.0, 2.0], 0, "")], SCHEMA)
    assert whitening.whitened(df.where("vec_id = 5")).collect() == []
    rows = whitening.whitened(df).collect()
    assert len(rows) == 4 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] == 0.0
                                  and r["deviation"] == 0 and r["n"] == 1 for r in rows)


def test_beyond_a_long(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0], 0, ""), (2, [0.0, 1.0], 0, "")], SCHEMA)
    rows = whitening.whitened(df.withColumn("embedding", F.col("embedding").cast("array<double>")))
    got = {(r["vec_id"], r["component"]): r for r in rows.collect()}
    assert len(got) == 4 and got[1, 1]["deviation"] is None and got[1, 2]["whitened"] is None


@pytest.mark.parametrize("kind", ["plain", "low rank", "equal", "wide range"])
def test_updates_give_the_scatter(kind):
    rng = np.random.default_rng(3)
    x = {"plain": rng.normal(size=(300, 24)) * 100,
         "low rank": rng.normal(size=(300, 5)) @ rng.normal(size=(5, 24)) * 50,
         "equal": np.tile(np.eye(24) * 100, (12, 1)),
         "wide range": rng.normal(size=(300, 24)) * np.logspace(0, 6, 24)}[kind]
    x = np.floor(x).astype(np.int64)
    one, two = whitening.Spectrum.empty(24), whitening.Spectrum.empty(24)
    one.add_rows(x[:100])
    one.add_rows(x[100:150])
    two.add_rows(x[150:])
    one.add(two)
    scatter = np.cov(x.T, bias=True) * len(x)
    top = np.abs(scatter).max()
    assert one.n == len(x) and one.sums == x.sum(axis=0).tolist()
    assert np.abs(one.vec.T @ one.vec - np.eye(24)).max() < 1e-12
    assert np.abs(one.vec * one.lam @ one.vec.T - scatter).max() < 1e-12 * top
    # a single direction, step by step
    lam, vec = np.zeros(24), np.eye(24)
    for row in x[:60] - x[:60].mean(axis=0):
        lam, vec = whitening.rank_one(lam, vec, row)
    assert np.abs(vec * lam @ vec.T - np.cov(x[:60].T, bias=True) * 60).max() < 1e-12 * top
