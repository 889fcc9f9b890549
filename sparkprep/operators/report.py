"""Size reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.constants import BYTES_PER_VALUE
from sparkprep.functions.formatting import format_bytes
from sparkprep.operators.schema import qcol


def matrix_size_report(df: DataFrame, key: str, features_col: str,
                       bytes_per_value: int = BYTES_PER_VALUE) -> DataFrame:
    """Per group: ``n_rows, n_cols`` (longest vector), ``size_bytes`` (values x 8)
    and a readable ``size_pretty``; one partially aggregated pass."""
    f = F.col(qcol(features_col))
    out = df.groupBy(qcol(key)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.when(f.isNotNull(), F.size(f))).cast("long").alias("n_cols"),
        (F.sum(F.when(f.isNotNull(), F.size(f))) * F.lit(bytes_per_value)).cast("long").alias("size_bytes"))
    return out.withColumn("size_pretty", format_bytes("size_bytes"))


def table_size_report(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """On-disk size of parquet tables ``{name: path}`` (files, or folders with any
    partitioning) from their file listing, no row of the tables read: ``table_name, n_files,
    size_bytes, table_size``, largest first, equal sizes by name. Hidden files do not count;
    a folder without parquet files has 0 files and 0 bytes, a missing path raises."""
    parts = []
    for name, path in tables.items():
        # one row for each file, its content not read; a folder counts with all below it
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))
        parts.append(files.agg(F.count(F.lit(1)).alias("n_files"),
                               F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))
                     .select(F.lit(name).alias("table_name"), "n_files", "size_bytes"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.withColumn("table_size", format_bytes("size_bytes"))
            .orderBy(F.col("size_bytes").desc(), "table_name"))
