"""Quality rules: base counts per document and cross-document line frequency.

Lines are normalised (lower-cased, white space folded, digits written 0) and
hashed; for each host, the distinct documents that hold a line are counted, where
documents of one host with identical text count once. Lines on more than
``max_docs`` documents of a host, however large the host is, are removed, and with
``max_share`` also those on more than ``min_docs`` documents and that share of the host's
distinct ones; a document is depleted, and rejected, when less than ``min_left`` of its
words remain. ``CORPUS`` holds the limits of the registered query and the pipeline.

Scale: lines are exploded to (host, line hash, text hash), combined map-side, and
never gathered by host; a row without line for each text counts the host's texts in the
same pass. Up to ``broadcast_lines`` lines over the limit (their counted
number decides) are broadcast as one array per host, and each document is judged in its
own row without moving its text. Beyond that the documents' lines are joined to them by
(host, line hash), which spreads a hot host over its lines, and combined to one row for
each document that has any; that row meets the document by host and text hash.

Defined results: a null text has no words and fails the base rules; null hosts are
one host; empty tables give empty results; repeated rows count once per text and
each gets its verdict. Extra columns are kept and cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import SPACE, WORD, of, one_space, word_count, written

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    """min_words and the repeat percentage are the base rules; the rest the line rules."""

    min_words: int = 10
    max_repeat_pct: int = 20
    window: int = 5
    max_docs: int = 40
    min_docs: int = 5
    max_share: float | None = None
    min_left: float = 0.3
    #: Broadcast the removed lines up to this many hashes (8 bytes each).
    broadcast_lines: int = 20_000


CORPUS = Limits(max_share=0.05)


def normal_line(line: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(one_space(line))), "[0-9]", "0")


def _pairs(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def _from(a: Column, k: int) -> Column:
    """The array from its k-th element on (0-based)."""
    return F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0)))


def repeated_words(words: DataFrame, window: int) -> DataFrame:
    """Adds n_repeat_words: words in windows found twice or more.

    ``words`` has the array column ``words``. Windows are hashed by zipping shifted
    copies of the word hashes, sorted with their positions, and kept where a
    neighbour in the sorted order has the same hash: n log n, within the row.
    """
    df = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df, built = df.withColumn("windows", F.col("hashes")), 1
    while built < window:  # windows of a and b <= a words, overlapped, make windows of a + b
        step = min(built, window - built)
        df = df.withColumn("windows", _pairs(F.col("windows"), _from(F.col("windows"), step)))
        built += step
    n = F.greatest(F.size("words") - (window - 1), F.lit(0))
    df = df.withColumn("windows", F.slice("windows", 1, n))
    # most documents repeat no window: only the others are sorted
    df = df.withColumn("windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
                                         F.col("windows")).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("sorted", F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    none = F.expr("array(cast(null as struct<h:bigint,i:int>))")
    ahead = F.concat(_from(F.col("sorted"), 1), none)
    behind = F.concat(none, F.col("sorted"))
    near = F.zip_with(F.zip_with(F.col("sorted"), ahead, lambda s, a: F.struct(
        s["h"].alias("h"), s["i"].alias("i"), (s["h"] == a["h"]).alias("same"))), behind,
        lambda s, b: F.when(s["same"] | (s["h"] == b["h"]), s["i"]))
    df = df.withColumn("starts", F.sort_array(F.filter(near, lambda i: i.isNotNull())))
    # a window covers the words up to the next window's start, the last one all its own
    gaps = F.zip_with(_from(F.col("starts"), 1), F.col("starts"), lambda b, a: F.least(
        F.coalesce(b - a, F.lit(window)), F.lit(window)))
    covered = F.aggregate(gaps, F.lit(0), lambda s, g: s + g)
    return df.withColumn("n_repeat_words", covered.cast("long"))


def base_counts(docs: DataFrame, id_col: str, text_col: str, limits: Limits = Limits()) -> DataFrame:
    """id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(of(docs, text_col), F.lit(""))
    df = docs.select(of(docs, id_col).alias("id"), text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    df = df.select("*", F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                   lines.alias("lines"),
                   F.filter(F.split("text", SPACE, -1), lambda w: w != "").alias("words"))
    df = df.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    df = repeated_words(df, limits.window).withColumn("n_words", F.size("words").cast("long"))
    failed = ((F.col("n_words") < limits.min_words)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeat_pct))
    return df.withColumn("base_failed", failed)


def _host(docs: DataFrame, host_col: str) -> Column:
    host = of(docs, host_col).cast("string")
    return F.when(host.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), host))


def _line_rows(docs: DataFrame, text_col: str, host_col: str, texts: bool = False) -> DataFrame:
    """Distinct (host, hash, doc): the lines of every text, ``doc`` being the text's hash;
    with ``texts`` also one row for each text, its ``hash`` null."""
    rows = docs.select(_host(docs, host_col).alias("host"), of(docs, text_col).alias("text"))
    one = rows.where(F.col("text").isNotNull()).select("host", F.xxhash64("text").alias("doc"),
                                                       F.split("text", "\n", -1).alias("lines"))
    each = F.array_distinct(F.transform("lines", normal_line))
    if texts:
        each = F.concat(each, F.array(F.lit(None).cast("string")))
    lines = one.select("host", "doc", F.explode(each).alias("line")).where("line is null or line <> ''")
    hashed = F.when(F.col("line").isNotNull(), F.xxhash64("line"))
    return lines.groupBy("host", hashed.alias("hash"), "doc").agg(F.lit(1).alias("one")).drop("one")


def frequent_lines(docs: DataFrame, text_col: str, host_col: str, limits: Limits = Limits()) -> DataFrame:
    """(host, hash) of the lines over a limit, counted over all documents."""
    shared = limits.max_share is not None
    held = _line_rows(docs, text_col, host_col, texts=shared).groupBy("host", "hash").agg(
        F.count(F.lit(1)).alias("held"))
    over = F.col("held") > limits.max_docs
    if not shared:
        return held.where(over).select("host", "hash")
    some = F.col("held") > min(limits.min_docs, limits.max_docs)
    held = written(held.where(F.col("hash").isNull() | some), "line-counts")
    sizes = held.where("hash is null").select(F.col("host").alias("s_host"), F.col("held").alias("n_docs"))
    lines = held.where("hash is not null")
    often = (F.col("held") > limits.min_docs) & (F.col("held") > F.col("n_docs") * F.lit(limits.max_share))
    return lines.join(sizes, lines["host"] == sizes["s_host"]).where(over | often).select("host", "hash")


def _with_removed(docs: DataFrame, text_col: str, host_col: str, limits: Limits) -> DataFrame:
    """``docs`` with ``__line_hashes``: hashes that hold its removed lines (null: none)."""
    over = written(frequent_lines(docs, text_col, host_col, limits), "lines")
    if over.count() <= limits.broadcast_lines:
        lines = over.groupBy("host").agg(F.collect_list("hash").alias("__line_hashes"))
        lines = F.broadcast(lines.withColumnRenamed("host", "__line_host"))
        return docs.join(lines, _host(docs, host_col) == lines["__line_host"], "left").drop("__line_host")
    lines = _line_rows(docs, text_col, host_col)
    marks = (lines.join(over, (lines["host"] == over["host"]) & (lines["hash"] == over["hash"]))
             .groupBy(lines["host"].alias("__line_host"), lines["doc"].alias("__line_doc"))
             .agg(F.collect_list(lines["hash"]).alias("__line_hashes")))
    return docs.join(marks, (_host(docs, host_col) == marks["__line_host"])
                     & (F.xxhash64(of(docs, text_col)) == marks["__line_doc"]), "left").drop(
        "__line_host", "__line_doc")


def _left(text: Column, hashes: Column) -> Column:
    """The text without its removed lines."""
    left = F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains(
        hashes, F.xxhash64(normal_line(x))))
    return F.when(hashes.isNull(), text).otherwise(F.array_join(left, "\n"))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Per document: the base counts, base_failed, words_left, kept and clean_text."""
    marked = _with_removed(docs, text_col, host_col, limits)
    text = F.coalesce(of(marked, text_col), F.lit(""))
    row = F.struct(of(docs, id_col).alias("id"), _left(text, F.col("__line_hashes")).alias("clean"))
    plain = marked.select(row.alias("__row"), text.alias("__text"))
    df = base_counts(plain, "__row", "__text", limits)
    df = df.withColumn("words_left", word_count(F.col("id.clean")))
    kept = ~F.col("base_failed") & (F.col("words_left") >= F.col("n_words") * F.lit(limits.min_left))
    return df.select(F.col("id.id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     "n_repeat_words", "base_failed", kept.alias("kept"), "words_left",
                     F.col("id.clean").alias("clean_text"))


def passed(docs: DataFrame, text_col: str = "text", host_col: str = "source",
           length_col: str | None = "n_chars", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, with all their columns; removed lines are cut from the
    text, and ``length_col`` (if there is one) follows the new text."""
    whole = docs.select(F.struct(*[of(docs, c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
                        .alias("__doc"), of(docs, text_col).alias("__text"),
                        of(docs, host_col).alias("__host"))
    found = verdicts(whole, "__doc", "__text", "__host", limits).select("__doc", "kept", "clean_text")
    # a generator of one row per document: below it the filter would repeat the rules' expressions
    good = found.select(F.inline(F.array(F.struct("__doc", "kept", "clean_text")))).where("kept")
    out = []
    for i, c in enumerate(docs.columns):
        old = F.col("__doc")[f"c{i}"]
        if c == text_col:
            old = F.col("clean_text")
        elif c == length_col:
            old = F.when(F.col("clean_text") == F.col("__doc")[f"c{docs.columns.index(text_col)}"],
                         old).otherwise(F.length("clean_text")).cast(docs.schema[c].dataType)
        out.append(old.alias(c))
    return good.select(*out)
