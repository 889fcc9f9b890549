"""Rows with repeated and null ids, blocks without shingles, and a whole table against all pairs."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkprep.llm import jaccard
from tests.conftest import SF_MID
from tests.llm.test_operators import brute_components, brute_sets

A = " ".join(f"alpha{i}" for i in range(120))
B = " ".join(f"beta{i}" for i in range(90))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, own string"


def brute_rows(rows, words, p):
    """(id, set size, component's smallest id) of rows that are documents of their own."""
    sets = brute_sets({i: r[1] for i, r in enumerate(rows)}, words)
    label = brute_components(sets, p)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[label[i]] = min(r[0], least.get(label[i], r[0]))
    return Counter((r[0], len(sets[i]), least.get(label[i])) for i, r in enumerate(rows))


def rows_of(pairs):
    return [(i, t, "en", "s", 1, f"row{k}") for k, (i, t) in enumerate(pairs)]


CASES = [
    [(3, A), (5, A + " more"), (5, B)],
    [(5, B), (3, A), (5, A + " more")],
    [(7, A), (7, A), (7, A + " x"), (None, A), (None, B), (None, B + " y"), (2, B), (9, None), (9, ""), (None, None)],
    [(1, A), (1, B), (2, A + " x"), (2, B + " y"), (1, "one two"), (4, "one two")],
]


@pytest.mark.parametrize("pairs", CASES)
def test_repeated_ids_are_rows_of_their_own(spark, pairs):
    rows = rows_of(pairs)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in jaccard.classes(docs, similarity=jaccard.Similarity(5, 80, 100)).collect())
    assert got == brute_rows(rows, 5, 80)


def test_the_stage_drops_rows_not_ids(spark):
    docs = spark.createDataFrame(rows_of([(3, A), (5, A + " more"), (5, B), (4, B + " z"), (None, A), (6, B)]), SCHEMA)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns and kept.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert sorted(r["own"] for r in kept.collect()) == ["row0", "row3"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4]


def test_whole_table_as_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter(tuple(r) for r in jaccard.classes(docs, similarity=jaccard.Similarity(4, 85, 100)).collect())
    assert got == brute_rows(rows, 4, 85)


@pytest.mark.parametrize("similarity", [jaccard.Similarity(4, 85, 100), jaccard.Similarity(5, 80, 100)])
def test_unrelated_sets_share_no_key(similarity):
    rng = np.random.default_rng(5)
    many, met = 0, Counter()
    keys = jaccard.Parities(similarity)
    for i in range(6, 24):  # sets at the lower edge of a band have the most empty blocks
        low = similarity.edge(i)
        for _ in range(150):
            own = keys.keys(np.unique(rng.integers(0, 2 ** 63, low, dtype=np.uint64)))
            many += len(own) > sum(k for _, k, _ in keys.bands(low))
            met.update(own.tolist())
    assert many  # some were dealt more than once
    assert max(met.values()) == 1


def test_sets_dealt_again_still_meet():
    """Linked sets share a key however many empty blocks both have."""
    s, rng, again = jaccard.Similarity(5, 80, 100), random.Random(3), 0
    keys = jaccard.Parities(s)
    for _ in range(4000):
        low = s.edge(rng.randrange(6, 20))
        base = [rng.getrandbits(63) for _ in range(low)]
        other = list(base)
        for at in rng.sample(range(low), s.bound(low, low) // 2):
            other[at] = rng.getrandbits(63)
        a, b = (keys.keys(np.unique(np.array(v, np.uint64))) for v in (base, other))
        again += len(a) > sum(k for _, k, _ in keys.bands(low))
        assert len(np.intersect1d(a, b))
    assert again > 20


def shuffled_bytes(spark):
    """Size of the session's shuffle files."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(f.stat().st_size for d in blocks.localDirsString() for f in Path(d).rglob("shuffle_*.data"))


def wide_rows(distinct_ids):
    """Documents of which a few are linked, with texts much wider than their block parities."""
    rng, pairs = random.Random(11), []
    for i in range(400):
        text = " ".join(f"{rng.getrandbits(96):024x}" for _ in range(400))
        pairs.append((i + 1, text))
        if i % 40 == 0:
            pairs += [(1001 + i, text + " more"), (2001 + i if distinct_ids else None, text + " yet more")]
    return rows_of(pairs)


@pytest.mark.parametrize("distinct_ids", [True, False])
def test_texts_of_unlinked_documents_are_not_shuffled(spark, tmp_path, distinct_ids):
    rows = wide_rows(distinct_ids)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled_bytes(spark)
        kept = sorted(r["own"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
        written = shuffled_bytes(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert kept == sorted(r[5] for r in rows if r[0] is not None and r[0] <= 400)
    assert written < 0.6 * sum(len(r[1]) for r in rows)


def test_sifting_loses_no_wanted_row(spark):
    rows = spark.range(20000).selectExpr("id as a", "id % 7 as b", "cast(id as string) as gone", "1 as sift_part")
    for wanted in (rows.where("a % 50 = 3"), rows.where("a < 0"), rows):
        without, perhaps = jaccard.sifted(rows, [rows["a"], rows["b"]], wanted.select("a", "b"))
        assert without.columns == perhaps.columns == rows.columns
        assert without.join(wanted.select("a", "b"), ["a", "b"], "left_semi").count() == 0
        n, many = perhaps.count(), wanted.count()
        assert n + without.count() == 20000 and many <= n <= many + 20000 // jaccard.SIFT_BITS
