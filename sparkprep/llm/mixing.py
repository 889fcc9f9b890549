"""Mixing sources to target weights along a time-varying curriculum.

Each source's weight follows a schedule over training time t in [0, 1],
given by knots (t, multiplier) joined linearly and scaled to integrate to 1. A
source's cumulative token demand is its target times the schedule's integral;
inverting it at the place a document holds in its source's hash order gives the
document's training position, by which the mix is range-sorted.

Scale: prefix sums inside a source never gather the source. Documents fall into
hash buckets of about ``BUCKET_DOCS``; sums per bucket (map-side combined), then
per super-bucket of ``FAN`` buckets, give offsets, and only the documents of one
bucket, the buckets of one super-bucket or the super-buckets of one source meet in
a window. The one global window runs over the table of sources, one row each.

The order key hashes id, seed and text, so rows with one repeated or null id spread over
the buckets like any others; only rows equal in id and text share a key. Sizes and keys
are worked out from the texts and written, without any other column, to the shared folder;
with ``carry`` they are worked out again beside the carried columns, so that no copy of the
texts is written and the texts move once to their buckets (and once into training order).
``docs`` is then read twice and must be the same both times, as written tables are.

Defined results: a null text has size 0; null sources are one source, ranked
last; a source without words has target 0; documents without words are not
taken; an empty table gives an empty mix; other columns, whatever their names, change
nothing and come along only with ``carry``. Rows equal in id and text are
interchangeable, and each is placed by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.llm.common import of, word_count, written

#: Mean number of documents per hash bucket, and buckets per super-bucket.
BUCKET_DOCS, FAN = 512, 1024
#: The table of sources is broadcast up to this many rows, joined by source beyond.
BROADCAST_SOURCES = 20_000


@dataclass(frozen=True)
class Mix:
    """Weights and schedules repeat over the sources in order of their names."""

    weights: tuple[int, ...] = (3, 1, 2)
    schedules: tuple[tuple[tuple[float, float], ...], ...] = (
        ((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
    budget: float = 1.5
    max_repeats: int = 2
    seed: str = "mix"


def segments(knots) -> list[tuple[float, float, float, float]]:
    """Pieces (t0, q0, m0, slope) of a schedule scaled to integrate to 1; q0 is the
    integral up to t0. Knots must start at 0, end at 1 and hold positive multipliers."""
    ts, ms = [float(t) for t, _ in knots], [float(m) for _, m in knots]
    if ts[0] != 0 or ts[-1] != 1 or any(a >= b for a, b in zip(ts, ts[1:])) or min(ms) <= 0:
        raise ValueError(f"schedule knots must rise from 0 to 1 with positive multipliers: {knots}")
    areas = [(b - a) * (x + y) / 2 for a, b, x, y in zip(ts, ts[1:], ms, ms[1:])]
    total, out, q = sum(areas), [], 0.0
    for a, b, x, y, area in zip(ts, ts[1:], ms, ms[1:], areas):
        out.append((a, q / total, x / total, (y - x) / (b - a) / total))
        q += area
    return out


def _position(q: Column, kind: Column, mix: Mix) -> Column:
    """Training time at which the share ``q`` of a source's demand is reached."""
    out = F.lit(None).cast("double")
    for k in reversed(range(len(mix.schedules))):
        here = None
        for t0, q0, m0, slope in segments(mix.schedules[k]):
            d = q - F.lit(q0)
            t = F.lit(t0) + F.lit(2.0) * d / (F.lit(m0) + F.sqrt(
                F.lit(m0) * F.lit(m0) + F.lit(2.0) * F.lit(slope) * d))
            here = t if here is None else F.when(q >= F.lit(q0), t).otherwise(here)
        out = F.when(kind == F.lit(k), here).otherwise(out)
    return out


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Per source: source_size, n_docs, rank, weight and target.

    Targets are weight x level, stopped at ``max_repeats`` x size, where the level
    makes them add up to the budget. Sources are capped in order of cap / weight, so
    the level follows from running sums over the table of sources (one row each).
    """
    by = Window.orderBy(F.col("src").asc_nulls_last())
    n, weights = len(mix.weights), F.array(*[F.lit(w) for w in mix.weights])
    table = (sizes.groupBy("src").agg(F.sum("size").alias("source_size"),
                                      F.count(F.lit(1)).alias("n_docs"))
             .withColumn("rank", F.row_number().over(by) - 1)
             .withColumn("weight", weights[F.pmod("rank", F.lit(n))].cast("long"))
             .withColumn("cap", F.col("source_size") * mix.max_repeats))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(float(mix.budget)) * F.col("total") - F.col("capped"))
             / (F.col("all_weights") - F.col("capped_weight")))
    table = (table.withColumn("total", F.sum("source_size").over(everything))
             .withColumn("all_weights", F.sum("weight").over(everything))
             .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
             .withColumn("capped_weight", F.coalesce(F.sum("weight").over(before), F.lit(0)))
             .withColumn("level", level)
             # the first source in filling order that its level does not cap sets it for the rest
             .withColumn("level", F.min(F.when(F.col("cap") >= F.col("weight") * F.col("level"),
                                               F.struct(F.col("cap") / F.col("weight"), "rank", "level")))
                         .over(everything)["level"]))
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
    return table.select("src", "source_size", "n_docs", "rank", target.alias("target"))


def planned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", mix: Mix = Mix(), carry: list[str] | None = None) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, positions (one per
    time it is taken) and order_key (its first position, or beyond 1 if not taken);
    with ``carry``, those columns of the document in the struct ``row``.

    A pass takes the document if more than half of it lies below the target.
    """
    text = of(docs, text_col)
    key = F.md5(F.concat_ws(":", F.coalesce(of(docs, id_col).cast("string"), F.lit("-")), F.lit(mix.seed),
                            F.md5(F.coalesce(text, F.lit("")))))
    narrow = [of(docs, id_col).alias("id"), of(docs, source_col).alias("src"),
              word_count(text).alias("size"), key.alias("key")]
    sizes = rows = written(docs.select(*narrow), "mix-sizes")
    if carry:
        rows = docs.select(*narrow, F.struct(*[of(docs, c).alias(f"c{i}") for i, c in enumerate(carry)])
                           .alias("row"))
    word = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    n_buckets = F.floor(F.col("n_docs") / BUCKET_DOCS) + 1
    sources = written(source_targets(sizes.select("src", "size"), mix), "mix").withColumnRenamed(
        "src", "t_src")
    if sources.count() <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)

    def dealt(df: DataFrame) -> DataFrame:
        df = df.join(sources, df["src"].eqNullSafe(sources["t_src"]))
        return df.withColumn("bucket", F.shiftright(word * n_buckets, 32))

    rows = dealt(rows)
    buckets = dealt(sizes).groupBy("rank", "bucket").agg(F.sum("size").alias("b_size"))
    buckets = buckets.withColumn("super", F.floor(F.col("bucket") / FAN))
    inner = Window.partitionBy("rank", "super").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    outer = Window.partitionBy("s_rank").orderBy("s_super").rowsBetween(
        Window.unboundedPreceding, -1)
    supers = (buckets.groupBy(F.col("rank").alias("s_rank"), F.col("super").alias("s_super"))
              .agg(F.sum("b_size").alias("s_size"))
              .withColumn("s_start", F.coalesce(F.sum("s_size").over(outer), F.lit(0))))
    starts = buckets.withColumn("b_start", F.coalesce(F.sum("b_size").over(inner), F.lit(0)))
    starts = (starts.join(supers, (starts["rank"] == supers["s_rank"])
                          & (starts["super"] == supers["s_super"]))
              .select(F.col("rank").alias("o_rank"), F.col("bucket").alias("o_bucket"),
                      (F.col("b_start") + F.col("s_start")).alias("offset")))
    placed = Window.partitionBy("rank", "bucket").orderBy("key", "id").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(placed), F.lit(0)))
    rows = rows.join(starts, (rows["rank"] == starts["o_rank"]) & (rows["bucket"] == starts["o_bucket"]))
    rows = rows.withColumn("start", F.col("offset") + F.col("ahead"))
    size, target, start = F.col("size"), F.col("target"), F.col("start")
    middles = [start + F.lit(p) * F.col("source_size") + size / F.lit(2.0)
               for p in range(mix.max_repeats)]
    kind = F.pmod("rank", F.lit(len(mix.schedules)))
    taken = sum((F.when((size > 0) & (m < target), 1).otherwise(0) for m in middles[1:]),
                F.when((size > 0) & (middles[0] < target), 1).otherwise(0))
    positions = F.filter(F.array(*[F.when((size > 0) & (m < target), _position(m / target, kind, mix))
                                   for m in middles]), lambda x: x.isNotNull())
    rows = rows.withColumn("taken", (size * taken).cast("long")).withColumn("positions", positions)
    late = F.lit(1.0) + (start + F.lit(1)) / (F.col("source_size") + F.lit(1))
    return rows.select("id", "size", "source_size", "target", "taken", "positions",
                       F.coalesce(F.get("positions", F.lit(0)), late).alias("order_key"), "key",
                       *(["row"] if carry else []))


def in_order(plan: DataFrame, by: str = "order_key") -> DataFrame:
    """Range-sorted by position: partitions follow each other in training time."""
    return plan.repartitionByRange(F.col(by), F.col("key")).sortWithinPartitions(by, "key")


def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", mix: Mix = Mix()) -> DataFrame:
    """The mix itself: the taken documents with all their columns, repeats included,
    range-sorted by training position."""
    plan = planned(docs, id_col, text_col, source_col, mix, carry=docs.columns)
    taken = plan.select("row", "key", F.explode("positions").alias("position"))
    ordered = in_order(taken, "position")
    return ordered.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])
