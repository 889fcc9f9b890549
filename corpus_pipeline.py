"""Training-text pipeline: quality rules, exact dedup, near dedup, source mix, BPE.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and
returns a DataFrame that is written as Parquet in the shared folder and reread. All but
the last return the columns of ``docs``; extra columns travel along.

Defined results: null and empty texts fail the quality rules; rows with a null or repeated doc_id
are documents of their own for the near-duplicate stage, a null doc_id coming after all others; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm import bpe, dedup, jaccard, mixing, quality
from sparkprep.llm.common import written
from sparkprep.llm.queries import vocabulary_path
from sparkprep.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines their hosts repeat too often."""
    return quality.passed(docs, limits=quality.CORPUS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text, the one with the smallest doc_id."""
    return dedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 5-word Jaccard 0.8 or more, the one with the smallest doc_id."""
    return jaccard.deduplicated(docs, similarity=jaccard.Similarity(words=5, p=80, q=100))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The taken documents (a document taken twice is there twice) in training order."""
    return mixing.curriculum(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix: doc_id, its token ids, their number, and the digest of the
    decoded text."""
    done = bpe.encoded(docs, vocabulary_path())
    return done.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("source mix", source_mix),
    ("BPE encoding", bpe_tokens),
]

#: SQL cannot express the last stage; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
