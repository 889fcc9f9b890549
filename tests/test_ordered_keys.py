"""Running totals and wide statistics where a key spans partitions or has no plain value."""

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkprep.operators import gram, linear
from sparkprep.operators.ordered import running_totals

KEYS = {
    "timestamp": [datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5), None],
    "timestamp_ntz": [datetime(2024, 1, 1), None],
    "double": [float("nan"), 1.5, 0.0, None],
    "string": ["a", "b", "", None],
    "decimal(10,2)": [1, 2, None],
    "struct<a:int,b:string>": [(1, "x"), (1, None), (2, "x")],
}


@pytest.mark.parametrize("kind", KEYS)
def test_totals_over_nine_partitions_equal_a_window(spark, kind):
    from decimal import Decimal
    keys = [Decimal(k) if "decimal" in kind and k is not None else k for k in KEYS[kind]]
    df = spark.createDataFrame([(keys[i % len(keys)], i, i % 7) for i in range(900)],
                               f"k {kind}, o int, v int")
    got = running_totals(df, "k", ["o"], "v", last_flag="final", num_partitions=9)
    same = Window.partitionBy("k").orderBy("o")
    want = (df.withColumn("cum", F.sum("v").over(same))
            .withColumn("final", F.lead("o").over(same).isNull()))
    assert (sorted(map(tuple, got.select("o", "cum", "final").collect()))
            == sorted(map(tuple, want.select("o", "cum", "final").collect())))


def test_one_key_holding_all_rows(spark):
    df = spark.range(1000).select(F.lit("x").alias("k"), "id", F.lit(1).alias("v"))
    got = running_totals(df, "k", ["id"], "v", last_flag="final", num_partitions=8).collect()
    assert sorted(r["cum"] for r in got) == list(range(1, 1001))
    assert [r["cum"] for r in got if r["final"]] == [1000]


@pytest.mark.parametrize("p", [5, gram.WIDE_P + 1])
def test_statistics_of_incomplete_groups_do_not_depend_on_the_width(spark, p):
    rows = [("a" if i % 3 else None, i, [float((i * 31 + j * 17) % 101) for j in range(p)], float(i))
            for i in range(300)]
    rows += [("empty", 7, [None] * p, 1.0), ("empty", 9, None, 2.0)]
    df = spark.createDataFrame(rows, "k string, r int, f array<double>, y double").repartition(5)
    got = {r["k"]: r for r in linear.ridge_by_group(df, "k", "f", "y", p=p).collect()}
    assert set(got) == {"a", None, "empty"} and got["empty"]["coef"] is None
    last = {r["k"]: r for r in linear.ridge_by_group_rows(df, "k", "r", "f", "y", p=p).collect()}
    assert {k: r["final_row"] for k, r in last.items()} == {"a": 299, None: 297, "empty": 9}
    none = df.where("k = 'empty'")
    fit = linear.linregr(none, "y", "f", p=p).collect()
    assert len(fit) == 1 and fit[0]["num_rows"] == 0
    assert linear.linregr(df.where("k = 'no'"), "y", "f", p=p).first()["num_rows"] == 0


def test_wide_statistics_join_no_rows(spark):
    p = gram.WIDE_P + 1
    df = spark.createDataFrame([("a", [1.0] * p)], "k string, f array<double>")
    plan = gram.gram_stats(df, gram.vector_elements("f", p), by=["k"])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan
