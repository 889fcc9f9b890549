"""Test fixtures derived from the given tables, each with a DuckDB twin.

The tables hold no NULLs in numeric columns and no collinear columns, so both
are injected by expressions that Spark and DuckDB evaluate identically. Every
fixture covers the whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.sources.tables import read_table


def _part(spark, sf):
    return read_table(spark, sf, "part")


def _nullif(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


# wide table with NULLs, a constant and an all-NULL column.
def f1_wide(spark: SparkSession, sf: str, dup_ids: bool = False) -> DataFrame:
    k = F.col("p_partkey")
    return _part(spark, sf).select(
        (k % 100 if dup_ids else k).alias("id"),
        _nullif(k % 7 == 0, F.col("p_size")).alias("f_size"),
        _nullif(k % 11 == 0, F.col("p_retailprice")).alias("f_price"),
        F.lit(1.0).alias("f_const"),
        F.lit(None).cast("double").alias("f_null"),
        (k % 3).alias("label"),
        F.lit(2024).alias("year"),
    )


def f1_sql(dup_ids: bool = False) -> str:
    idexpr = "p_partkey % 100" if dup_ids else "p_partkey"
    return f"""SELECT {idexpr} AS id,
        CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS f_size,
        CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS f_price,
        CAST(1.0 AS DOUBLE) AS f_const,
        CAST(NULL AS DOUBLE) AS f_null,
        p_partkey % 3 AS label,
        2024 AS year
    FROM part"""


# F3-F5: collinear features (x3 near-collinear, x5 = 3 * x1 exactly, x3 with NULLs).
def f3_collinear(spark: SparkSession, sf: str, exact: bool = False,
                 nulls: bool = False) -> DataFrame:
    k = F.col("p_partkey")
    x1 = F.col("p_size")
    x2 = F.col("p_retailprice")
    x3 = (F.lit(2.0) * x1.cast("double") + F.lit(0.01) * x2 + (k % 5).cast("double"))
    if nulls:
        x3 = _nullif(k % 6 == 0, x3)
    cols = [k.alias("id"), x1.alias("x1"), x2.alias("x2"), x3.alias("x3"),
            (k % 13).alias("x4")]
    if exact:
        cols.append((F.lit(3.0) * x1.cast("double")).alias("x5"))
    return _part(spark, sf).select(*cols)


def f3_sql(exact: bool = False, nulls: bool = False) -> str:
    x3 = ("2.0 * CAST(p_size AS DOUBLE) + CAST(0.01 AS DOUBLE) * p_retailprice"
          " + CAST(p_partkey % 5 AS DOUBLE)")
    if nulls:
        x3 = f"CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE {x3} END"
    x5 = ", 3.0 * CAST(p_size AS DOUBLE) AS x5" if exact else ""
    return f"""SELECT p_partkey AS id, p_size AS x1, p_retailprice AS x2, {x3} AS x3,
        p_partkey % 13 AS x4{x5} FROM part"""


# vector layout of a wide fixture, names sorted.
def to_vectors(df: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    names = sorted(cols)
    return df.select(F.col(id_col).alias("id"),
                     F.array(*[F.lit(n) for n in names]).alias("feature_names"),
                     F.array(*[F.col(n).cast("double") for n in names]).alias("features"))


def to_vectors_sql(src_sql: str, cols: list[str]) -> str:
    names = sorted(cols)
    n_arr = ", ".join(f"'{n}'" for n in names)
    v_arr = ", ".join(f"CAST({n} AS DOUBLE)" for n in names)
    return f"SELECT id, [{n_arr}] AS feature_names, [{v_arr}] AS features FROM ({src_sql})"


# clustering input.
def f7_points(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "embeddings").select(
        F.col("vec_id"), F.col("embedding").cast("array<double>").alias("x"))


F7_SQL = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"


# grouped regression input.
F9_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def f9_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        F.array(*[F.col(c) for c in F9_FEATURES]).alias("features"),
        F.col("l_extendedprice").alias("label"))


F9_SQL = ("SELECT l_returnflag AS model, [l_quantity, l_discount, l_tax] AS features,"
          " l_extendedprice AS label FROM lineitem")


# ordered arrays per customer; NULL arrays, and whole NULL groups.
def f10_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    arr = F.array(F.col("o_totalprice"), F.col("o_orderkey").cast("double"))
    nul = (F.col("o_orderkey") % 9 == 0) | (F.col("o_custkey") % 10 == 0)
    return o.select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("ord"),
                    F.when(nul, F.lit(None)).otherwise(arr).alias("arr"))


F10_SQL = """SELECT o_custkey AS key, o_orderkey AS ord,
    CASE WHEN o_orderkey % 9 = 0 OR o_custkey % 10 = 0 THEN NULL
         ELSE [o_totalprice, CAST(o_orderkey AS DOUBLE)] END AS arr
    FROM orders"""


# part rows as (id, features real[3], quality real) before replication.
def f11_base(spark: SparkSession, sf: str) -> DataFrame:
    p = _part(spark, sf)
    feats = F.array(F.col("p_size").cast("float"), F.col("p_retailprice").cast("float"),
                    (F.col("p_partkey") % 13).cast("float"))
    q = (F.lit(0.1) * F.col("p_size").cast("double") + F.lit(0.002) * F.col("p_retailprice")
         + (F.col("p_partkey") % 3).cast("double")).cast("float")
    return p.select(F.col("p_partkey").alias("id"), feats.alias("features"), q.alias("quality"))


F11_SQL = """SELECT p_partkey AS id,
    [CAST(p_size AS FLOAT), CAST(p_retailprice AS FLOAT), CAST(p_partkey % 13 AS FLOAT)] AS features,
    CAST(CAST(0.1 AS DOUBLE) * CAST(p_size AS DOUBLE) + CAST(0.002 AS DOUBLE) * p_retailprice
         + CAST(p_partkey % 3 AS DOUBLE) AS FLOAT) AS quality
    FROM part"""
