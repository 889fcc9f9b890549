"""URL filters: temporal list join.

Dated list entries (domain, date, action, category) become validity intervals: an
``add`` is active from its date until the next entry of the same domain and
category, exclusive. A capture is blocked when an interval of its host or one of
the host's parent domains holds its fetch date; the entry in force with the
longest domain is reported (then the latest, then the first category).

Scale: captures are first combined to distinct (host, fetch date), so a host with a
third of all captures is judged once per date; intervals and captures meet on
(domain, 32-day block), which spreads a hot domain over time; an interval has a row only
for blocks in which its domain was captured, however long it is or if it never ends; the
verdicts join back on (host, date). Nothing is broadcast by hand.

Defined results: a null or unparsable URL has host null and is not blocked; a
capture without fetch date is not blocked; list rows without domain or date are
ignored; entries of one domain, category and date count once, ``add`` winning over
``remove``, and a null category is the empty one; an entry whose action is not ``add`` (null
too) ends the interval; repeated captures each get their row; empty captures or lists give no
row and no blocked row. Extra columns of captures are kept beside the result when named in
``carry`` (default: all), but for those with the name of a result column: the result's stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.llm.common import ascii_lower, of

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)"
BLOCK_DAYS = 32
RESULT = ("host", "blocked", "list_domain", "category", "listed_on")


def host_of(url: Column) -> Column:
    """Lower-cased host (a bracketed address whole) without user, port and trailing dots; null if
    there is none."""
    host = F.regexp_replace(ascii_lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")
    return F.when(host != "", host)


def _block(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / BLOCK_DAYS).cast("int")


def intervals(entries: DataFrame) -> DataFrame:
    """(domain, category, valid_from, valid_to) of the dated entries; an open end is null."""
    day = of(entries, "date").cast("date")
    one = (entries.select(ascii_lower(of(entries, "domain")).alias("domain"),
                          F.coalesce(of(entries, "category"), F.lit("")).alias("category"),
                          day.alias("valid_from"),
                          F.coalesce((of(entries, "action") == "add").cast("int"), F.lit(0)).alias("added"))
           .where("domain is not null and valid_from is not null")
           .groupBy("domain", "category", "valid_from").agg(F.max("added").alias("added")))
    later = Window.partitionBy("domain", "category").orderBy("valid_from")
    return one.withColumn("valid_to", F.lead("valid_from").over(later)).where("added = 1").drop("added")


def matched(captures: DataFrame, entries: DataFrame, url_col: str, date_col: str) -> DataFrame:
    """(host, fetched, list_domain, category, listed_on) of the blocked hosts and dates."""
    seen = (captures.select(host_of(of(captures, url_col)).alias("host"),
                            of(captures, date_col).cast("date").alias("fetched"))
            .where("host is not null and fetched is not null").distinct())
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    parts = seen.select("host", "fetched", F.explode(domains).alias("part"), _block(F.col("fetched")).alias("part_block"))
    # an interval meets the blocks in which its own domain was captured, no others
    blocks = parts.select(F.col("part").alias("b_part"), F.col("part_block").alias("block")).distinct()
    spans = intervals(entries)
    spans = spans.join(blocks, (spans["domain"] == blocks["b_part"]) & (blocks["block"] >= _block(spans["valid_from"]))
                       & (spans["valid_to"].isNull() | (blocks["block"] <= _block(F.date_sub(spans["valid_to"], 1)))))
    hits = parts.join(spans, (parts["part"] == spans["domain"]) & (parts["part_block"] == spans["block"])
                      & (parts["fetched"] >= spans["valid_from"])
                      & (spans["valid_to"].isNull() | (parts["fetched"] < spans["valid_to"])))
    best = F.min(F.struct((-F.length("domain")).alias("longest"),
                          F.datediff(F.col("fetched"), F.col("valid_from")).alias("age"),
                          "category", "domain", "valid_from"))
    return (hits.groupBy("host", "fetched").agg(best.alias("best"))
            .select("host", "fetched", F.col("best.domain").alias("list_domain"),
                    F.col("best.category").alias("category"), F.col("best.valid_from").alias("listed_on")))


def filtered(captures: DataFrame, entries: DataFrame, url_col: str = "url",
             date_col: str = "fetched_on", carry: list[str] | None = None) -> DataFrame:
    """Every capture with host, blocked, list_domain, category and listed_on; ``carry``
    names the capture's own columns to keep (default: all)."""
    own = [c for c in (carry if carry is not None else captures.columns) if c.lower() not in RESULT]
    found = matched(captures, entries, url_col, date_col).select(
        F.col("host").alias("m_host"), F.col("fetched").alias("m_fetched"), "list_domain", "category",
        "listed_on")
    rows = captures.select(F.struct(*[of(captures, c).alias(f"c{i}") for i, c in enumerate(own)])
                           .alias("row"), host_of(of(captures, url_col)).alias("host"),
                           of(captures, date_col).cast("date").alias("fetched"))
    out = rows.join(found, (rows["host"] == found["m_host"]) & (rows["fetched"] == found["m_fetched"]),
                    "left")
    return out.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(own)], "host",
                      F.col("list_domain").isNotNull().alias("blocked"), "list_domain", "category",
                      "listed_on")
