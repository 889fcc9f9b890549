"""Models from merged partial states, and residuals of dependent columns from one factorisation."""

import time

import numpy as np
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import linalg, linear


class Spread(linear.MergeableTrainer):
    """Smallest, largest and number of a column, with the number of tasks that saw the group."""

    state_schema = "lo double, hi double, n long, tasks long"
    result_schema = "lo double, hi double, n long, tasks long"

    def partial(self, state, rows):
        new = {"lo": pc.min(rows["v"]).as_py(), "hi": pc.max(rows["v"]).as_py(), "n": rows.num_rows, "tasks": 1}
        return new if state is None else {**self.merge(state, new), "tasks": 1}

    def merge(self, a, b):
        return {"lo": min(a["lo"], b["lo"]), "hi": max(a["hi"], b["hi"]), "n": a["n"] + b["n"],
                "tasks": a["tasks"] + b["tasks"]}

    def finish(self, state):
        return state


def test_a_group_of_all_rows_is_trained_by_all_tasks(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").cast("double").alias("v")).repartition(12)
    (row,) = linear.grouped_train(df, "k", Spread()).collect()
    assert tuple(row) == ("hot", 0.0, 4999.0, 5000, 12)


def test_keys_of_any_kind_and_flushed_states(spark, monkeypatch):
    monkeypatch.setattr(linear, "HELD_GROUPS", 2)
    keys = [None, "a", "b", "c", "", "d"]
    rows = [(keys[i % 6], float("nan") if i % 4 == 0 else float(i % 4), float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, `odd key` double, v double").repartition(5)
    got = {(r["k"], str(r["odd key"])): r for r in linear.grouped_train(df, ["k", "odd key"], Spread()).collect()}
    want = {}
    for k, o, v in rows:
        want.setdefault((k, str(o)), []).append(v)
    assert set(got) == set(want)
    assert all((r["lo"], r["hi"], r["n"]) == (min(want[g]), max(want[g]), len(want[g])) for g, r in got.items())
    assert linear.grouped_train(df.limit(0), "k", Spread()).collect() == []


def test_ridge_from_states_equals_the_statistics(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 3, None if i == 5 else [float(v) if i != 7 else None for v in rng.normal(1e6, 1, 2)],
             None if i == 9 else float(rng.normal())) for i in range(300)] + [(9, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, f array<double>, y double").repartition(7)
    a = {r["k"]: r for r in linear.grouped_train(df, "k", linear.RidgeTrainer("f", "y")).collect()}
    b = {r["k"]: r for r in linear.ridge_by_group(df, "k", "f", "y", p=2).collect()}
    assert set(a) == {0, 1, 2, 9} and a[9]["coef"] is None
    for k in (0, 1, 2):
        assert np.allclose(a[k]["coef"], b[k]["coef"], rtol=1e-6) and abs(a[k]["r_square"] - b[k]["r_square"]) < 1e-9


def _products(x):
    return x.T @ x


@pytest.mark.parametrize("seed", range(8))
def test_residuals_with_dependent_columns(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(200, 9)) * 10.0 ** rng.integers(-2, 3, 9)
    cols = [*x.T]
    if seed % 2:
        cols += [x[:, 0] + 2 * x[:, 1], x[:, 3] * 4]
    if seed % 3 == 0:
        cols += [x[:, 0] - x[:, 5], np.zeros(200)]
    cp = _products(np.column_stack([cols[i] for i in rng.permutation(len(cols))]))
    got = linalg.all_residuals(cp)
    for j in range(len(cp)):
        left = linalg.regress(cp, j, [q for q in range(len(cp)) if q != j])[1]
        if left <= 1e-9 * cp[j, j]:
            assert got[j] <= 1e-9 * cp[j, j]
        else:
            assert abs(got[j] / left - 1) < 1e-6


def test_residuals_near_the_tolerance_are_not_decided():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(100, 3))
    x = np.column_stack([x, x[:, 0] + 1e-5 * rng.normal(size=100)])
    assert linalg.all_residuals(_products(x)) is None


def test_many_columns_with_a_dependent_pair_are_quick():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 499))
    cp = _products(np.column_stack([x, x[:, 17]]))
    t0 = time.time()
    left = linalg.all_residuals(cp)
    assert time.time() - t0 < 2.0
    assert left[17] == left[499] == 0.0 and (np.delete(left, [17, 499]) > 100).all()
