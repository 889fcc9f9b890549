"""Physical-plan checks: column pruning at the scan, no needless exchange, no
Python in operators that are pure column expressions or aggregates."""

from pyspark.sql import functions as F

from sparkprep.operators import arrays, gram, impute, synth
from sparkprep.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> int:
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") \
        + plan.count("Exchange rangepartitioning") + plan.count("Exchange RoundRobin")


PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas",
                "FlatMapGroupsInPandas")


def test_normalised_columns_are_one_projection(spark):
    out = impute.impute_normalize_columns(fx.f1_wide(spark, SF_SMALL), "id", exclude=["label", "year"])
    plan = _plan(out)
    assert _exchanges(plan) == 0
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int,p_retailprice:double>" in plan
    assert not any(p in plan for p in PYTHON_NODES)


def test_unique_id_vectors_need_no_shuffle(spark):
    out = impute.impute_normalize_vectors(fx.f1_wide(spark, SF_SMALL), "id", label_col="label",
                                          constant_term=True, unique_id=True)
    assert _exchanges(_plan(out)) == 0


def test_grouped_statistics_are_one_partial_aggregate(spark):
    df = fx.f9_lineitem(spark, SF_SMALL)
    st = gram.gram_stats(df, gram.vector_elements("features", 3) + [F.col("label")], by=["model"])
    plan = _plan(st)
    assert _exchanges(plan) == 1
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double," \
           "l_tax:double,l_returnflag:string>" in plan
    assert not any(p in plan for p in PYTHON_NODES)


def test_group_sizes_never_build_arrays(spark):
    out = arrays.array_group_size(fx.f10_orders(spark, SF_SMALL), "key", "arr")
    plan = _plan(out)
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan
    assert _exchanges(plan) == 1


def test_synthetic_data_is_generated_in_tasks(spark):
    plan = _plan(synth.synth_array(spark, 1000, n_rows=3, layout="long"))
    assert _exchanges(plan) == 0 and "Range" in plan
    assert not any(p in plan for p in PYTHON_NODES)
