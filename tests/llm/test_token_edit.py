"""Edit-aware counts against encoding the edited text as a whole."""

import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm import bpe, token_edit
from sparkprep.llm.common import written
from sparkprep.llm.queries import vocabulary_path

PIECES = ["word", " the", " it's", "  ", "\n", "\n\n ", "12", " 345", "été", "中文", "\U0001f600", "...", "<|endoftext|>",
          "<|end", "of", "text|>", "<", "|", "a" * 70, " " * 40, "'", "s", "\t", "x"]
ROW = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("edits", token_edit.EDITS), T.StructField("tree", T.StringType()),
                    T.StructField("n_tokens", T.LongType())])


@pytest.fixture(scope="module")
def counter():
    return token_edit.EditCounter(bpe.Encoder(bpe.load_vocabulary(vocabulary_path())))


def some_text(rng, n):
    return "".join(rng.choice(PIECES) for _ in range(n))


def some_edits(rng, size, n):
    cuts = sorted(rng.randint(0, size) for _ in range(2 * n))
    return [(a, min(b, a + 30), some_text(rng, rng.choice([0, 0, 1, 2, 9]))) for a, b in zip(cuts[::2], cuts[1::2])]


def applied(text, edits):
    for a, b, new in reversed(edits):
        text = text[:a] + new + text[b:]
    return text


def test_random_edits_equal_whole_encoding(counter, monkeypatch):
    monkeypatch.setattr(token_edit, "LEAF", 3)  # many leaf borders
    rng = random.Random(4)
    for _ in range(1500):
        text = some_text(rng, rng.choice([0, 1, 5, 40, 200]))
        tree = counter.build(text)
        for _ in range(3):  # the tree goes on to the next edits
            edits = some_edits(rng, len(text), rng.choice([0, 1, 2, 6]))
            before, tree, _, new = counter.edited(text, edits, tree)
            assert (before, new) == (len(counter.encoder.encode(text)), applied(text, edits))
            whole = len(counter.encoder.encode(new))
            assert (tree.total, tree.chars[1], sum(tree.leaves()[1])) == (whole, len(new), whole), (text, edits)
            text = new


def test_tokens_equal_the_library(counter):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary_path())
    rng = random.Random(5)
    for text in ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", *[some_text(rng, 60) for _ in range(100)]]:
        assert counter.build(text).total == len(lib.encode(text, add_special_tokens=False).ids)


def test_joining_an_added_token(counter):
    text = "start <|endof and so on " * 30
    at = text.index("<|endof", 300) + len("<|endof")
    _, tree, again, new = counter.edited(text, [(at, at, "text|>")])
    assert tree.total == len(counter.encoder.encode(new)) and again < len(text)


def test_many_edits_take_linear_time(counter):
    took = {}
    for n in (2_000, 16_000):
        text = "some words here, " * (6 * n)
        edits = [(100 * i, 100 * i + 4, "none") for i in range(n)]
        tree = counter.build(text)
        start = time.process_time()
        counter.edited(text, edits, tree)
        took[n] = time.process_time() - start
    assert took[16_000] < 30 * took[2_000]  # 64 times if each edit copied the text


def test_one_edit_encodes_little_again(counter):
    text = "some words here, " * 20_000
    _, _, again, _ = counter.edited(text, [(100_000, 100_004, "none")])
    assert 0 < again < 2_000


def test_kept_trees_serve_the_next_edits(spark):
    rng = random.Random(6)
    texts = [some_text(rng, 300) for _ in range(40)] + ["", None]
    rows = [(i, t, some_edits(rng, len(t or ""), 4), "clash", -1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ROW)
    first = token_edit.counted(docs, vocabulary_path())
    assert first.columns == ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_again", "edited_text",
                             "refused", "tree"]
    kept = written(first, "trees")
    done = {r["doc_id"]: r["edited_text"] for r in kept.collect()}
    assert done == {i: applied(t or "", e) for i, t, e, _, _ in rows}
    edits = {i: some_edits(rng, len(t), 2) for i, t in done.items()}
    more = spark.createDataFrame(list(edits.items()), T.StructType([ROW["doc_id"], ROW["edits"]]))
    second = token_edit.counted(kept.join(more, "doc_id"), vocabulary_path(), text_col="edited_text", tree_col="tree")
    plain = token_edit.counted(spark.createDataFrame(
        [(i, applied(t, edits[i]), None, None, None) for i, t in done.items()], ROW), vocabulary_path())
    want = {r["doc_id"]: (r["n_tokens"], r["edited_text"]) for r in plain.collect()}
    assert {r["doc_id"]: (r["n_tokens_edited"], r["edited_text"]) for r in second.collect()} == want
    stale = token_edit.counted(kept.withColumn("edits", F.lit(None).cast(token_edit.EDITS))
                               .withColumn("edited_text", F.lit("another text")), vocabulary_path(),
                               text_col="edited_text", tree_col="tree")
    assert {r["n_tokens_edited"] for r in stale.collect()} == {2}


def test_bad_edits_are_refused_row_by_row(spark):
    bad = [[(0, 3, "x"), (2, 4, "y")], [(3, 99, "x")], [(2, 1, "x")], [(-1, 1, "x")], [(None, 1, "x")], [None],
           [(4, 5, "x"), (0, 1, "y")]]
    rows = [(i, "a few words", e, None, None) for i, e in enumerate([*bad, [(0, 1, None)], None])]
    out = {r["doc_id"]: r for r in token_edit.counted(spark.createDataFrame(rows, ROW), vocabulary_path()).collect()}
    for i in range(len(bad)):
        assert out[i]["refused"] and out[i]["edited_text"] == "a few words"
        assert out[i]["n_tokens"] == out[i]["n_tokens_edited"] == 3
    assert (out[7]["refused"], out[7]["edited_text"], out[7]["n_tokens_edited"]) == (None, " few words", 2)
    assert (out[8]["refused"], out[8]["n_edits"]) == (None, 0)
