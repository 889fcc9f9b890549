"""Parquet table sources and result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    for n in names or TABLES:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def write_result(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> None:
    """CTAS-equivalent sink: replace ``path`` with ``df`` as parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
