"""Synthetic data: hash-uniform arrays and columns, and row replication.

All values are pure functions of (key, position, seed) (see
``functions.hashing``), generated on executors from ``spark.range`` or from the
rows of an input table; the driver never builds data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions.hashing import hash_uniform
from sparkprep.operators.schema import qcol


def synth_uniform(source, n: int | None = None, id_col: str = "id",
                  cols=("x", "y"), seed: int = 42) -> DataFrame:
    """Uniform (0, 1) columns. ``source`` is a SparkSession (rows ``id = 1..n``)
    or a DataFrame whose ``id_col`` keys the values."""
    if isinstance(source, SparkSession):
        base = source.range(1, int(n) + 1).withColumnRenamed("id", id_col)
    else:
        base = source.select(F.col(qcol(id_col)))
    return base.select(F.col(qcol(id_col)),
                       *[hash_uniform(qcol(id_col), F.lit(i + 1), seed=seed).alias(c)
                         for i, c in enumerate(cols)])


def synth_array(source, size, id_col: str = "row", seed: int = 42, n_rows: int = 1,
                layout: str = "array") -> DataFrame:
    """Arrays of ``size`` uniforms per row (``gen_array`` of the reference).

    ``source``: a DataFrame (``id_col`` keys the row, ``size`` may be a column
    name) or a SparkSession (rows ``row = 1``, ``y = 1..n_rows`` as in the
    reference, ``size`` an int). ``layout="long"`` yields ``(..., pos, value)``
    element rows, generated by ``spark.range`` across all tasks, for arrays
    beyond the ~2 GB row limit.
    """
    if isinstance(source, SparkSession):
        if layout == "long":
            total = int(n_rows) * int(size)
            r = source.range(0, total)
            y = (F.col("id") / F.lit(int(size))).cast("long") + 1
            pos = F.col("id") % F.lit(int(size)) + 1
            return r.select(F.lit(1).alias("row"), y.alias("y"), pos.alias("pos"),
                            hash_uniform(y, pos, seed=seed).alias("value"))
        base = source.range(1, int(n_rows) + 1).select(F.lit(1).alias("row"), F.col("id").alias("y"))
        key, sz = F.col("y"), F.lit(int(size))
    else:
        base = source
        key = F.col(qcol(id_col))
        sz = F.col(qcol(size)) if isinstance(size, str) else F.lit(int(size))
    if layout == "long":
        return base.select("*", F.posexplode(F.sequence(F.lit(1), sz)).alias("_p", "pos")).select(
            *[F.col(qcol(c)) for c in base.columns], "pos",
            hash_uniform(key, F.col("pos"), seed=seed).alias("value"))
    arr = F.when(sz > 0, F.transform(F.sequence(F.lit(1), sz),
                                     lambda i: hash_uniform(key, i, seed=seed))).otherwise(
        F.array().cast("array<double>"))
    return base.select("*", arr.alias("arr"))


def replicate_shuffle(df: DataFrame, id_col: str, n_models: int, n_repeats: int,
                      seed: int = 42, keep=("features", "quality")) -> DataFrame:
    """Every row ``n_models x n_repeats`` times, numbered within each model in a
    hash-random order: ``model, row_indx (long), <keep columns>``.

    Replication is a generator (no join). Numbering uses the ordered scan, so a
    model's rows are spread over many tasks instead of one window partition.
    """
    from sparkprep.operators.ordered import running_totals
    rep = (df.select(F.col(qcol(id_col)).alias("_id"), *[F.col(qcol(c)) for c in keep],
                     F.explode(F.sequence(F.lit(1), F.lit(int(n_models)))).alias("model"))
           .select("*", F.explode(F.sequence(F.lit(1), F.lit(int(n_repeats)))).alias("_rep")))
    rep = rep.withColumn("_u", hash_uniform("_id", "model", "_rep", seed=seed))
    numbered = running_totals(rep, "model", ["_u", "_id", "_rep"], F.lit(1), "row_indx")
    return numbered.select(F.col("model").cast("int").alias("model"), "row_indx",
                           *[F.col(qcol(c)) for c in keep])
