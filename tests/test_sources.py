"""Sources and sinks."""

from pyspark.sql import functions as F

from sparkprep.sources import TABLES, read_table, register_views, write_result
from tests.conftest import SF_SMALL


def test_register_views_and_read_table(spark):
    register_views(spark, SF_SMALL, ["part", "lineitem"])
    n_sql = spark.sql("SELECT count(*) AS n FROM part").first()["n"]
    assert n_sql == read_table(spark, SF_SMALL, "part").count()
    assert set(["part", "lineitem", "embeddings"]) <= set(TABLES)


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = read_table(spark, SF_SMALL, "lineitem").filter(F.col("l_quantity") > 10).select("l_tax")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan


def test_write_result_replaces_target(spark, tmp_path):
    out = str(tmp_path / "res")
    write_result(spark.range(5), out)
    write_result(spark.range(3), out)
    assert spark.read.parquet(out).count() == 3


def test_shipped_package_contains_every_module(spark, monkeypatch):
    import os
    import zipfile

    import sparkprep
    from sparkprep import session

    added = []
    monkeypatch.setattr(session, "_SHIPPED", set())
    monkeypatch.setattr(spark.sparkContext, "addPyFile", lambda p: added.append(p))
    session.ship_package(spark)
    session.ship_package(spark)
    assert len(added) == 1
    names = set(zipfile.ZipFile(added[0]).namelist())
    root = os.path.dirname(os.path.dirname(os.path.abspath(sparkprep.__file__)))
    expected = {os.path.relpath(os.path.join(d, f), root)
                for d, _, fs in os.walk(os.path.dirname(sparkprep.__file__)) for f in fs if f.endswith(".py")}
    assert expected <= names
