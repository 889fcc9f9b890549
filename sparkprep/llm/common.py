"""Helpers shared by the text operators.

White space is always ``[\\x20\\x09-\\x0D]`` and a word is a run of anything
else, the same in Spark's, Python's and DuckDB's regular expressions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other code point left alone (engine-independent)."""
    return F.translate(c, _UPPER, _UPPER.lower())


def one_space(c: Column) -> Column:
    """Each run of white space replaced by one space."""
    return F.regexp_replace(c, SPACE, " ")


def word_count(c: Column) -> Column:
    """Number of words as a long; null texts count 0."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def of(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df``, whatever characters the name has."""
    return df["`" + name.replace("`", "``") + "`"]


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Per open ``passing`` block, the paths that go with it.
_PASSING: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())
#: With it, Spark drops an execution's shuffle files at its end instead of when the driver
#: happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes in this block are deleted at its end, but for those that
    outlive it. No DataFrame over one of the others may be used after the block."""
    paths: list[str] = []
    token = _PASSING.set((*_PASSING.get(), paths))
    try:
        yield
    finally:
        _PASSING.reset(token)
        sc = spark.sparkContext
        for name in paths:
            path = sc._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str, *, outlives: bool = False) -> DataFrame:
    """``df`` as a parquet table in the shared folder, read back.

    Cuts the lineage like ``checkpoint()`` but keeps column pruning for the
    passes that follow, and lost executors cost no recomputation. Shuffle files
    of the execution that writes go with its end. In a ``passing`` block the
    table goes with the block, or with ``outlives`` with the one around it.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    blocks = _PASSING.get()[:-1] if outlives else _PASSING.get()
    if blocks:
        blocks[-1].append(path)
    usual = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, usual)
    return spark.read.schema(df.schema).parquet(path)
