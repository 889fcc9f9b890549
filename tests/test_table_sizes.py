"""On-disk sizes against the file system's own."""

import os

import pytest
from pyspark.sql import functions as F

from sparkprep.operators.report import table_size_report
from sparkprep.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def on_disk(path):
    """Files and bytes of a table, hidden files and folders left out."""
    if os.path.isfile(path):
        return 1, os.path.getsize(path)
    found = []
    for folder, below, files in os.walk(path):
        below[:] = [b for b in below if b[0] not in "._"]
        found += [os.path.getsize(os.path.join(folder, f)) for f in files
                  if f.endswith(".parquet") and f[0] not in "._"]
    return len(found), sum(found)


def test_registered_report_equals_the_file_system(spark):
    rows = QUERIES["table_size_report"](spark, SF_SMALL).collect()
    assert {r["table_name"] for r in rows} == {"lineitem", "orders", "part", "embeddings"}
    for r in rows:
        assert (r["n_files"], r["size_bytes"]) == on_disk(f"{SF_SMALL}/{r['table_name']}.parquet")
    assert [r["size_bytes"] for r in rows] == sorted((r["size_bytes"] for r in rows), reverse=True)


def test_folders_partitions_and_empty_tables(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("many", "parted", "none", "again")}
    spark.range(1_000).repartition(5).write.parquet(paths["many"])
    (spark.range(100).withColumn("k", F.col("id") % 3).repartition(2).write.partitionBy("k")
     .parquet(paths["parted"]))
    spark.range(100).write.parquet(paths["again"])
    os.mkdir(paths["none"])
    (tmp_path / "many" / "notes.txt").write_text("no data")
    (tmp_path / "many" / "_hidden.parquet").write_text("no data")
    rows = {r["table_name"]: r for r in table_size_report(spark, paths).collect()}
    for name, path in paths.items():
        assert (rows[name]["n_files"], rows[name]["size_bytes"]) == on_disk(path), name
    assert (rows["none"]["n_files"], rows["none"]["size_bytes"]) == (0, 0)
    assert rows["many"]["n_files"] == 5 and rows["parted"]["n_files"] >= 3


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|not exist"):
        table_size_report(spark, {"gone": str(tmp_path / "gone")}).collect()


def test_plan_reads_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    plan = table_size_report(spark, {"t": path})._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]
