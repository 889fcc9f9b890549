"""What the near-duplicate join reads, shuffles and leaves behind."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkprep.llm import common, jaccard
from tests.llm.test_jaccard_rows import SCHEMA, brute_rows, rows_of, shuffled_bytes


def tables(spark):
    """Names of the tables in the session's shared folder."""
    return {p.name for p in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).iterdir()}


def long_documents():
    """Long documents that share nothing but common phrases, two of them with a linked variant."""
    rng = random.Random(4)
    phrases = [[f"common{i}x{k}" for k in range(5)] for i in range(60)]
    texts = []
    for _ in range(24):
        words = [f"{rng.getrandbits(40):x}" for _ in range(4800)]
        for phrase in phrases:
            at = rng.randrange(len(words))
            words[at:at] = phrase
        texts.append(words)
    more = [[f"{rng.getrandbits(40):x}" for _ in range(400)] for _ in range(2)]
    return [" ".join(t) for t in [*texts, texts[3] + more[0], texts[9] + more[1]]]


def test_long_documents_with_common_phrases_are_not_read_in_pairs(spark, monkeypatch):
    rows = rows_of(list(enumerate(long_documents())))
    compared, verified = [], jaccard.verified

    def counted(pairs, *rest):
        compared.extend(tuple(r) for r in pairs.select("a", "b").collect())
        return verified(pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", counted)
    found = jaccard.classes(spark.createDataFrame(rows, SCHEMA))
    labels = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert labels == {i: {24: 3, 25: 9}.get(i, i) for i in range(26)}
    assert set(compared) == {(3, 24), (9, 25)}  # of 325 pairs; before, many unrelated ones too


@pytest.mark.parametrize("similarity", [jaccard.Similarity(4, 85, 100), jaccard.Similarity(5, 80, 100)])
def test_sketches_tell_large_sets_apart_and_never_part_linked_ones(similarity):
    rng = np.random.default_rng(8)

    def distance(a, b):
        x, y = jaccard.same_length([jaccard.sketch(v, similarity.bits(len(v))) for v in (a, b)])
        return int(np.bitwise_count(x ^ y).sum())

    for n in (300, 1000, 2300, 4600, 9300, 20000):
        base, other = (np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64)) for _ in range(2))
        wider = np.concatenate([other, rng.integers(0, 2 ** 63, n // 5, dtype=np.uint64)])
        assert distance(base, other) > similarity.bound(n, n)
        assert distance(base, wider) > similarity.bound(n, len(wider))
        for share in (20, 10):
            near = np.concatenate([base[n // share:], rng.integers(0, 2 ** 63, n // share // 2, dtype=np.uint64)])
            assert distance(base, near) <= n // share + n // share // 2


def test_folded_sketches_in_sql(spark):
    rng = np.random.default_rng(9)
    sets = [rng.integers(0, 2 ** 63, 900, dtype=np.uint64) for _ in range(3)]
    bits = [1024, 4096, 2048]
    rows = [(i, jaccard.sketch(s, b).view(np.int64).tolist()) for i, (s, b) in enumerate(zip(sets, bits))]
    t = spark.createDataFrame(rows, "i long, s array<long>")
    both = t.toDF("i", "s").crossJoin(t.toDF("j", "t")).select("i", "j", jaccard._hamming("s", "t").alias("d"))
    for i, j, d in both.collect():
        short = min(bits[i], bits[j])
        x, y = (jaccard.sketch(sets[k], short) for k in (i, j))
        assert d == int(np.bitwise_count(x ^ y).sum())


def test_buckets_with_the_same_members_are_kept_once(spark):
    reps = spark.createDataFrame([(1, list(range(50))), (2, list(range(60))), (3, list(range(50, 60))), (4, [99])],
                                 "id long, keys array<long>")
    members = {}
    for key, i, first in jaccard.bucket_rows(reps).collect():
        members.setdefault((key, first), set()).add(i)
    pairs = {(first, frozenset(m)) for (_, first), m in members.items()}
    assert pairs == {(1, frozenset({1, 2})), (2, frozenset({2, 3}))}
    assert len(members) <= 6  # of 60 buckets; the bitmap may let a few through


def test_the_stage_leaves_no_tables_of_its_steps(spark):
    rows = rows_of([(i, t) for i, t in enumerate(long_documents()[:6])] + [(40, "a b c d e f"), (41, "a b c d e f")])
    docs = spark.createDataFrame(rows, SCHEMA)
    before, held = tables(spark), shuffled_bytes(spark)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    left = {name.rpartition("-")[0] for name in tables(spark) - before}
    assert not left & {"features", "facts", "sets", "hot", "met", "kept", "buckets", "mixed", "near", "pairs",
                       "checked", "edges"}
    assert shuffled_bytes(spark) < held + 10_000  # those of the steps went with them, bar single counts
    assert {r["own"] for r in kept.collect()} == {r[5] for r in rows} - {"row7"}
    found = jaccard.classes(docs)
    assert sorted(map(tuple, found.collect())) == sorted(brute_rows(rows, 5, 80).elements())


def test_passing_tables(spark):
    usual = spark.conf.get(common._CLEANUP)
    rows = spark.range(10)
    with common.passing(spark):
        outer = common.written(rows, "outer")
        lasting = common.written(rows, "lasting", outlives=True)
        with common.passing(spark):
            inner = common.written(outer.groupBy((F.col("id") % 3).alias("k")).count(), "inner")
            lifted = common.written(inner, "lifted", outlives=True)
        assert lifted.count() == 3 and outer.count() == 10
        names = {n.rpartition("-")[0] for n in tables(spark)}
        assert "inner" not in names and {"outer", "lifted", "lasting"} <= names
    names = {n.rpartition("-")[0] for n in tables(spark)}
    assert not names & {"outer", "inner", "lifted"} and lasting.count() == 10
    with pytest.raises(ZeroDivisionError), common.passing(spark):
        common.written(rows, "failing")
        raise ZeroDivisionError
    assert not any(n.startswith("failing-") for n in tables(spark))
    assert spark.conf.get(common._CLEANUP) == usual
