"""Exact dedup by skew-safe combining.

Texts are equal when identical after replacing each run of white space by one
space. Three levels, each grouping by digest *and* the whole normalised text, so
two different texts that share a digest never merge:

1. locally: the map-side half of the aggregate leaves one row per text and task;
2. salted: rows of one text meet per (text, salt), where the salt is the task's
   number modulo ``salts``, so that a text held by a third of all rows reaches a
   reducer only once per map task and is spread over ``salts`` of them;
3. globally: at most ``salts`` salt winners per text are combined.

Defined results: a null text counts as empty; an empty table gives an empty
result; of rows with equal text the smallest id stays, a null id counting as
largest, then the smallest fingerprint of the remaining columns; rows repeated in
every column are one document (``winners`` has it once; ``verdicts`` gives each
repeat the same row). Extra columns never clash: only the id and the text are
read, and carried columns travel inside one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import of, one_space

#: Reducers over which the copies of one text are spread at the salted level.
SALTS = 16


def sha256_digest(c: Column) -> Column:
    return F.sha2(c, 256)


def _normal(docs: DataFrame, text_col: str) -> Column:
    return one_space(F.coalesce(of(docs, text_col), F.lit("")))


def _order(docs: DataFrame, id_col: str) -> Column:
    """Sorts rows of equal text: known ids first, by id, then by the other columns."""
    rest = [of(docs, c).cast("string") for c in sorted(docs.columns)]
    return F.struct(of(docs, id_col).isNull().alias("no_id"), of(docs, id_col).alias("id"),
                    F.xxhash64(*rest).alias("rest"))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
            carry: list[str] | None = None, salts: int = SALTS,
            digest=sha256_digest) -> DataFrame:
    """One row per distinct text: ``digest``, ``content``, ``best`` (no_id, id, rest), ``n``.

    ``carry`` names columns of the winning row that travel along, in ``row``.
    Whole texts are compared at the local, the salted and the global level.
    """
    row = F.struct(*[of(docs, c).alias(f"c{i}") for i, c in enumerate(carry)]) if carry else None
    rows = docs.select(_normal(docs, text_col).alias("content"),
                       _order(docs, id_col).alias("best"),
                       *([row.alias("row")] if carry else []),
                       F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    rows = rows.withColumn("digest", digest(F.col("content")))

    def combined(df: DataFrame, *keys: str, n: Column) -> DataFrame:
        kept = [F.min_by("row", "best").alias("row")] if carry else []
        return df.groupBy(*keys).agg(F.min("best").alias("best"), n.alias("n"), *kept)

    salted = combined(rows, "digest", "content", "salt", n=F.count(F.lit(1)))
    return combined(salted, "digest", "content", n=F.sum("n"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    best = winners(docs, id_col, text_col, carry=docs.columns, salts=salts)
    return best.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
             salts: int = SALTS, digest=sha256_digest) -> DataFrame:
    """Every row's verdict: id, keep_id, group_size, kept, text_sha256.

    Winners are joined back by digest: narrow rows (no text) on both sides, one
    row per text on the winners' side, so that Spark's skew join splits the rows
    of a hot text. Should two texts share a digest, length, 64-bit and 512-bit
    hashes of the content tell their rows apart.
    """
    best = winners(docs, id_col, text_col, salts=salts, digest=digest)
    content = _normal(docs, text_col)
    rows = docs.select(of(docs, id_col).alias("id"), content.alias("content"),
                       _order(docs, id_col).alias("me"))
    rows = rows.select("id", "me", digest(F.col("content")).alias("digest"),
                       F.sha2("content", 256).alias("text_sha256"),
                       F.struct(F.length("content"), F.xxhash64("content"),
                                F.sha2("content", 512)).alias("check"))
    best = best.select(F.col("digest").alias("w_digest"),
                       F.struct(F.length("content"), F.xxhash64("content"),
                                F.sha2("content", 512)).alias("w_check"),
                       F.struct("best.no_id", "best.id", "best.rest").alias("w"),
                       F.col("n").alias("group_size"))
    found = rows.join(best, (rows["digest"] == best["w_digest"])
                      & (rows["check"] == best["w_check"]))
    return found.select(F.col("id").alias(id_col), F.col("w.id").alias("keep_id"), "group_size",
                        F.col("me").eqNullSafe(F.col("w")).alias("kept"), "text_sha256")
