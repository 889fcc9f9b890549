"""The manifest against a plain recursive version and the standard library's digests."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkprep.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, root string"
ROWS = ([(None, "a", None, "s", 3, "p", "r"), (1, None, "en", "s", None, "p", "r"), (1, None, "en", "s", None, "p", "r"),
         (7, "", "en", None, 9223372036854775807, "p", "r"), (5, "é" * 70_000, "", None, 2, "p", "r")]
        + [(i, f"t{i}", "xx" if i % 3 else "yy", "s", i, "p", "r") for i in range(100)])


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in merkle.FIELDS))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def path(tree, i, arity):
    for nodes in tree[:-1]:
        first = i // arity * arity
        yield nodes[first:i], nodes[i + 1:first + arity]
        i //= arity


def brute(rows, arity):
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    langs = sorted(by, key=lambda v: (v is not None, (v or "").encode()))
    trees = []
    for lang in langs:
        by[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append(levels([leaf(r) for r in by[lang]], arity))
    top = levels([t[-1][0] for t in trees], arity)
    root = top[-1][0]
    for k, (lang, tree) in enumerate(zip(langs, trees)):
        for i, r in enumerate(by[lang]):
            steps = [*path(tree, i, arity), *path(top, k, arity)]
            now = dict(r)
            if None not in (r["doc_id"], r["n_chars"]) and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0:
                now["n_chars"] += 1
            end = leaf(now)
            for left, right in steps:
                end = H(*left, end, *right)
            proof = H(*(x for left, right in steps for x in (*left, *right)))
            yield r["doc_id"], leaf(r), tree[-1][0], root, proof, end, end == root


def test_states_are_the_standard_librarys():
    x = np.random.default_rng(1).integers(0, 2 ** 32, (5, 8), dtype=np.uint32)
    texts, level = merkle._hex(x), merkle._parents(x, 3)
    assert merkle._hex(level.digests) == [H(*texts[:3]), H(*texts[3:])]
    # the kept state before the third slot, resumed with another child
    other = merkle.compress(level.states[:1, 1], merkle._text(x[4:5]))
    assert merkle._hex(merkle._closed(other, np.array([3]))) == [H(*texts[:2], texts[4])]


@pytest.mark.parametrize("arity, depth", [(2, 12), (2, 2), (3, 1), (5, 2)])
def test_as_plain_recursion(spark, arity, depth):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = merkle.manifest(docs, merkle.tampered, arity=arity, depth=depth).collect()
    assert Counter(map(tuple, got)) == Counter(brute([r.asDict() for r in docs.collect()], arity))


def test_whole_until_changed(spark):
    got = merkle.manifest(spark.createDataFrame(ROWS[:20], SCHEMA)).collect()
    assert len(got) == 20 and all(r["verified"] for r in got)


def test_no_row_and_one_row(spark):
    docs = spark.createDataFrame(ROWS[:1], SCHEMA)
    assert merkle.manifest(docs.limit(0), merkle.tampered).collect() == []
    (one,) = merkle.manifest(docs, merkle.tampered).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"]
    assert one["proof_sha256"] == hashlib.sha256(b"").hexdigest()
