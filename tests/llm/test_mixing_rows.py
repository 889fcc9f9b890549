"""The mix over rows that share an id."""

import os

import pytest
from pyspark.sql import functions as F

from sparkprep.llm import mixing
from sparkprep.session import checkpoint_dir

SCHEMA = "doc_id long, text string, source string, size int, key string, row string"


def rows_of(n, ids):
    return [(ids(i), f"some words number {i}", "s", 7, "clash", "clash") for i in range(n)]


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 5])
def test_one_id_spreads_over_the_buckets(spark, ids):
    plan = mixing.planned(spark.createDataFrame(rows_of(4_000, ids), SCHEMA)).cache()
    assert plan.select("key").distinct().count() == 4_000
    word = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    n_buckets = 4_000 // mixing.BUCKET_DOCS + 1
    sizes = plan.groupBy(F.shiftright(word * n_buckets, 32)).count().collect()
    assert len(sizes) == n_buckets and max(r["count"] for r in sizes) < 2 * 4_000 / n_buckets
    row = plan.agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"), F.max("target").alias("target"),
                   F.max(F.col("taken") / F.col("size")).alias("most")).first()
    assert row["size"] == 16_000 and row["most"] <= 2 and abs(row["taken"] - row["target"]) <= 8


def test_equal_rows_each_have_a_place(spark):
    docs = spark.createDataFrame([(1, "same words here", "s", 0, "", "")] * 30, SCHEMA)
    got = [r for r in mixing.planned(docs).collect()]
    assert len(got) == 30 and len({r["key"] for r in got}) == 1
    assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 6
    again = sorted((r["taken"], r["order_key"]) for r in mixing.planned(docs.repartition(7)).collect())
    assert again == sorted((r["taken"], r["order_key"]) for r in got)


def test_carried_columns_keep_their_names(spark):
    docs = spark.createDataFrame(rows_of(20, lambda i: i), SCHEMA)
    mix = mixing.curriculum(docs)
    assert mix.columns == docs.columns and {r["key"] for r in mix.collect()} == {"clash"}
    assert mixing.planned(docs.limit(0)).count() == 0


def test_the_mix_writes_no_copy_of_the_texts(spark, tmp_path):
    def tables():
        at = checkpoint_dir(spark).removeprefix("file:")
        return {os.path.join(at, d) for d in os.listdir(at)}

    texts = {i: " ".join(f"w{i}x{j * j}" for j in range(300)) for i in range(200)}
    path = f"{tmp_path}/docs"
    spark.createDataFrame([(i, t, "abc"[i % 3], i, "k", "r") for i, t in texts.items()], SCHEMA).write.parquet(path)
    docs, before = spark.read.parquet(path), tables()
    mix = mixing.curriculum(docs).collect()
    new = tables() - before
    assert new and all("text" not in n and "row" not in n for d in new for n in spark.read.parquet(d).columns)
    plan = {r["id"]: r for r in mixing.planned(docs).collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in mix)
    places = sorted((p, r["key"], i) for i, r in plan.items() for p in r["positions"])
    assert [r["doc_id"] for r in mix] == [i for _, _, i in places]  # range-sorted, repeats included
