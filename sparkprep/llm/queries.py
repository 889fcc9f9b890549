"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions.hashing import hash_uniform
from sparkprep.llm import (bpe, dedup, html_text, jaccard, licenses, merkle, mixing, quality,
                           secret_scan, small_world, token_edit, url_filter, whitening)
from sparkprep.llm.sql import merkle_sql, mixing_sql, quality_sql, url_filter_sql
from sparkprep.sources.tables import read_table


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary file lies; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every document before and after a cleaning pass over it."""
    docs = token_edit.cleaning_edits(read_table(spark, sf, "documents"))
    return token_edit.counted(docs, vocabulary_path()).withColumn(
        "edited_sha256", F.sha2("edited_text", 256)).drop("edited_text", "refused", "tree")


def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scanned(read_table(spark, sf, "documents"))
    return found.select("doc_id", "n_blocks", F.size("matches").cast("long").alias("n_matches"),
                        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",")
                        .alias("licenses"),
                        F.array_join(F.transform("matches", lambda m: F.concat_ws(
                            ":", m["license"], m["start"].cast("string"), m["end"].cast("string"),
                            m["missing"].cast("string"), m["added"].cast("string"))), ",")
                        .alias("matches"),
                        F.array_join(F.transform("matches", lambda m: F.format_number(m["reduction"], 4)), ",")
                        .alias("reductions"))


def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Every page against a dated list of a third of the pages' own domains.

    The tables hold neither fetch dates nor a list, so both are derived from all
    pages: fetch dates from the page id, list entries from hashes of the domain.
    """
    pages = read_table(spark, sf, "pages")
    days = (F.pmod(F.col("page_id") * 7919, F.lit(366))).cast("int")
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), days)
                            .alias("fetched_on"))
    domain = F.regexp_extract(url_filter.host_of(pages["url"]), r"([^.]+\.[^.]+\.[^.]+)$", 1)
    domains = pages.select(domain.alias("domain")).where("domain <> ''").distinct()

    def draw(what: str, n: int):
        return F.floor(hash_uniform("domain", seed=what) * n).cast("int")

    first = draw("first", 200)
    start = F.lit("2024-01-01").cast("date")
    steps = F.array(
        F.struct(F.date_add(start, first).alias("date"), F.lit("add").alias("action")),
        F.struct(F.date_add(start, first + 20 + draw("pause", 60)).alias("date"),
                 F.lit("remove").alias("action")),
        F.struct(F.date_add(start, first + 100 + draw("again", 60)).alias("date"),
                 F.lit("add").alias("action")))
    entries = (domains.where(hash_uniform("domain", seed="listed") < 1 / 3)
               .select("domain", F.when(draw("kind", 2) == 0, "spam").otherwise("malware")
                       .alias("category"), F.explode(steps).alias("e"))
               .select("domain", "category", "e.date", "e.action"))
    return url_filter.filtered(captures, entries, carry=["page_id", "url", "fetched_on"])


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.verdicts(read_table(spark, sf, "documents"), limits=quality.CORPUS).drop("clean_text")


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.verdicts(read_table(spark, sf, "documents"))


def op6_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.in_order(mixing.planned(read_table(spark, sf, "documents")))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
                       F.get("positions", F.lit(0)).alias("position"))


def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scanned(read_table(spark, sf, "documents")))


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf, "documents"), vocabulary_path())


def op9_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.classes(read_table(spark, sf, "documents"),
                           similarity=jaccard.Similarity(words=4, p=85, q=100))


def op10_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extracted(read_table(spark, sf, "pages"))


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened(read_table(spark, sf, "embeddings"))


def op12_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return small_world.classes(read_table(spark, sf, "embeddings"))


def op13_merkle(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf, "documents"), merkle.tampered)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_source_mix": op6_source_mix,
    "op7_secret_scan": op7_secret_scan,
    "op8_bpe": op8_bpe,
    "op9_ngram_join": op9_ngram_join,
    "op10_html_text": op10_html_text,
    "op11_whitening": op11_whitening,
    "op12_near_vectors": op12_near_vectors,
    "op13_merkle": op13_merkle,
}

OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

ORACLES: dict[str, Callable[[], str]] = {
    "op3_url_filter": url_filter_sql,
    "op4_quality_rules": quality_sql,
    "op5_exact_dedup": lambda: OP5_SQL,
    "op6_source_mix": mixing_sql,
    "op13_merkle": merkle_sql,
}
