"""Merkle manifest of a table as a SHA-256 midstate tree.

A leaf is the digest of a row's columns; per language the leaves ascend by id and every
``arity`` consecutive nodes become the digest of their concatenated hexadecimal texts; the
languages' roots, in order, likewise give the root of the table.

A digest's text has 64 bytes, which is exactly one block of SHA-256, so the hash state of a
parent before each child's slot is a plain 32-byte value. Parents keep a copy of that state for
every slot (the first one's is the standard's initial value and is not stored). Folding a
changed child up to the root resumes its parent's state before its slot, adds the replacement
and then the siblings to its *right* only; siblings to the left are never read again.

Scale: digests of rows are computed by Spark's own functions, so no text leaves the JVM.
Positions in a language come from the library's ordered scan, which spreads a language over as
many tasks as it needs. A tree grows in rounds: ``arity ** depth`` consecutive nodes (4,096 by
default) are one chunk, whose levels are computed in one task, and the chunks' roots are the next
round's nodes, so ten thousand million rows take three rounds. Each chunk is one row of the
written tree (inner digests and states, under 0.3 MB); folding brings a chunk's rows, its row of
the tree and the one path above it together. Nothing but the number of rounds reaches the driver,
nothing is broadcast, and every table between rounds lies in the shared folder.

Defined results: every row is a leaf, repeated rows too; null columns count as ``-``; ids that are
null come first in their language; rows with equal ids lie in the order of their digests; ``n_chars``
plus one is computed as a decimal, so the largest long does not overflow; an empty table
gives an empty result; a single row's leaf is its language's root and the root; columns other than
the five hashed ones are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import of, written
from sparkprep.operators.ordered import running_totals
from sparkprep.session import ship_package

#: Children of a parent, and levels of a chunk (a chunk has ARITY ** DEPTH nodes).
ARITY, DEPTH = 2, 12
#: Trees (languages) whose sizes are broadcast, 100 bytes each; beyond it they are shuffled.
BROADCAST_TREES = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ SHA-256 on many rows at once
def _primes(n: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < n:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _root(x: int, k: int) -> int:
    """The integer part of the k-th root of x."""
    lo, hi = 0, 1 << (x.bit_length() // k + 1)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if mid ** k <= x else (lo, mid - 1)
    return lo


#: The standard's constants: 32 bits behind the point of roots of the first primes.
_K = np.array([_root(p << 96, 3) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
START = np.array([_root(p << 64, 2) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states (n, 8) after one more block (n, 16) each; all values are uint32."""
    w = [np.ascontiguousarray(block[:, t]) for t in range(16)]
    for t in range(16, 64):
        a, b = w[t - 15], w[t - 2]
        w.append(w[t - 16] + (_turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3))) + w[t - 7]
                 + (_turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10))))
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(state[:, i]) for i in range(8))
    for t in range(64):
        one = (h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + ((e & f) ^ (~e & g)) + _K[t] + w[t])
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h], axis=1)


def _text(digests: np.ndarray) -> np.ndarray:
    """The block (n, 16) that the hexadecimal texts of digests (n, 8) make."""
    raw = digests.astype(">u4").view(np.uint8).reshape(-1, 32)
    chars = np.empty((len(raw), 64), np.uint8)
    chars[:, 0::2], chars[:, 1::2] = _HEX[raw >> 4], _HEX[raw & 15]
    return chars.view(">u4").astype(np.uint32)


def _closed(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests of messages of ``children`` texts each, from the states after the last one."""
    block = np.zeros((len(state), 16), np.uint32)
    block[:, 0] = 0x80000000
    bits = children.astype(np.uint64) * np.uint64(512)
    block[:, 14], block[:, 15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return compress(state, block)


def _packed(words: np.ndarray) -> bytes:
    return words.astype(">u4").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8)


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    """Digests (n, 8) of a column of 64-character texts."""
    return _unpacked(bytes.fromhex("".join(column.to_pylist())))


def _hex(digests: np.ndarray) -> list[str]:
    raw = _packed(digests).hex()
    return [raw[at:at + 64] for at in range(0, len(raw), 64)]


# ------------------------------------------------------------------ levels of one chunk
@dataclass
class _Level:
    """Parents of consecutive nodes: ``states[r, s]`` is parent r's state before slot s + 1."""
    digests: np.ndarray
    states: np.ndarray
    children: np.ndarray


def _children(n: int, arity: int) -> np.ndarray:
    runs = -(-n // arity)
    out = np.full(runs, arity, np.int64)
    out[-1:] = n - arity * (runs - 1)
    return out


def _parents(nodes: np.ndarray, arity: int) -> _Level:
    children = _children(len(nodes), arity)
    state = np.tile(START, (len(children), 1))
    kept = np.zeros((len(children), arity - 1, 8), np.uint32)
    for s in range(arity):
        there = np.flatnonzero(children > s)
        if s:
            kept[there, s - 1] = state[there]
        state[there] = compress(state[there], _text(nodes[there * arity + s]))
    return _Level(_closed(state, children), kept, children)


def _height(n: int, depth: int, arity: int) -> int:
    """Levels that a chunk rises in this round, where its tree has ``n`` nodes."""
    levels = 0
    while n > 1 and levels < depth:
        n, levels = -(-n // arity), levels + 1
    return levels


TREE = T.StructType([T.StructField("tree", T.StringType()), T.StructField("pos", T.LongType()),
                     T.StructField("n", T.LongType()), T.StructField("digest", T.StringType()),
                     T.StructField("inner", T.BinaryType()), T.StructField("states", T.BinaryType())])
STEP = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("children", T.IntegerType()),
                     T.StructField("state", T.BinaryType()), T.StructField("left", T.StringType()),
                     T.StructField("right", T.StringType())])
PATH = T.StructType([T.StructField("tree", T.StringType()), T.StructField("pos", T.LongType()),
                     T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType()),
                     T.StructField("path", T.ArrayType(STEP))])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _grow(arity: int, depth: int) -> Callable[[pa.Table], pa.Table]:
    schema = _arrow(TREE)

    def grow(chunk: pa.Table) -> pa.Table:
        chunk = chunk.sort_by("pos")
        tree, n = chunk["tree"][0].as_py(), chunk["n"][0].as_py()
        nodes, inner, states = _digests(chunk["digest"]), [], []
        for _ in range(_height(n, depth, arity)):
            level = _parents(nodes, arity)
            nodes = level.digests
            inner.append(_packed(level.digests))
            states.append(_packed(level.states))
        at = chunk["pos"][0].as_py() // arity ** depth
        row = {"tree": tree, "pos": at, "n": -(-n // arity ** depth), "digest": _hex(nodes)[0],
               "inner": b"".join(inner), "states": b"".join(states)}
        return pa.Table.from_pylist([row], schema=schema)

    return grow


def _levels(nodes: np.ndarray, row: dict, n: int, arity: int, depth: int) -> list[_Level]:
    """The chunk's levels as its row of the written tree holds them."""
    inner, states = _unpacked(row["inner"]), _unpacked(row["states"]).reshape(-1, arity - 1, 8)
    out, at, size = [], 0, len(nodes)
    for _ in range(_height(n, depth, arity)):
        children = _children(size, arity)
        size = len(children)
        out.append(_Level(inner[at:at + size], states[at:at + size], children))
        at += size
    return out


# ------------------------------------------------------------------ rounds over a forest
def grown(nodes: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> list[tuple[DataFrame, DataFrame]]:
    """Rounds (nodes, rows of the tree) of all trees, from the leaves up.

    ``nodes`` has tree, pos (from 0 in each tree), n (nodes of the tree) and digest; the last round's
    rows of the tree are the roots, one for each tree.
    """
    ship_package(nodes.sparkSession)
    rounds = []
    while True:
        chunk = F.floor(F.col("pos") / F.lit(arity ** depth)).alias("chunk")
        rows = nodes.groupBy("tree", chunk).applyInArrow(_grow(arity, depth), TREE)
        rows = written(rows, "merkle")
        rounds.append((nodes, rows))
        most = rows.agg(F.max("n")).first()[0]
        if most is None or most == 1:
            return rounds
        nodes = rows.select("tree", "pos", "n", "digest")


def _joined(nodes: DataFrame, rows: DataFrame, above: DataFrame, size: int,
            work: Callable, schema: T.StructType) -> DataFrame:
    """``work(nodes, row, step)`` for each chunk, with its row of the tree and the path above it."""
    up = above.select(F.col("tree").alias("u_tree"), F.col("pos").alias("u_pos"), "subroot", "root", "path")
    held = rows.join(up, (rows["tree"] == up["u_tree"]) & (rows["pos"] == up["u_pos"]))
    held = held.select("tree", F.col("pos").alias("chunk"), "inner", "states", "subroot", "root", "path")
    parts = nodes.withColumn("chunk", F.floor(F.col("pos") / F.lit(size)))
    return (parts.groupBy("tree", "chunk").cogroup(held.groupBy("tree", "chunk"))
            .applyInArrow(work, schema))


def _siblings(level: _Level, nodes: list[str], arity: int, slot_of: int, parent: int) -> tuple[str, str]:
    first = parent * arity
    run = nodes[first:first + int(level.children[parent])]
    return "".join(run[:slot_of]), "".join(run[slot_of + 1:])


def _state_before(level: _Level, parent: np.ndarray, slot: np.ndarray) -> np.ndarray:
    state = np.tile(START, (len(parent), 1))
    later = slot > 0
    state[later] = level.states[parent[later], slot[later] - 1]
    return state


def _descend(arity: int, depth: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Paths from every node of a chunk to the root of its tree and beyond."""
    schema = _arrow(PATH)

    def descend(chunk: pa.Table, held: pa.Table) -> pa.Table:
        row = held.to_pylist()[0]
        chunk = chunk.sort_by("pos")
        nodes = _digests(chunk["digest"])
        levels = _levels(nodes, row, chunk["n"][0].as_py(), arity, depth)
        texts = [_hex(nodes), *(_hex(level.digests) for level in levels)]
        out = []
        for i, pos in enumerate(chunk["pos"].to_pylist()):
            steps, at = [], i
            for k, level in enumerate(levels):
                parent, slot = divmod(at, arity)
                left, right = _siblings(level, texts[k], arity, slot, parent)
                state = _state_before(level, np.array([parent]), np.array([slot]))
                steps.append({"slot": slot, "children": int(level.children[parent]), "state": _packed(state),
                              "left": left, "right": right})
                at = parent
            out.append({"tree": row["tree"], "pos": pos, "subroot": row["subroot"], "root": row["root"],
                        "path": steps + row["path"]})
        return pa.Table.from_pylist(out, schema=schema)

    return descend


def folded(digest: np.ndarray, path: list[dict]) -> np.ndarray:
    """Roots (n, 8) that the digests give along one path: each step's state is resumed with the
    digest, then takes the siblings to the right."""
    for step in path:
        state = np.tile(_unpacked(step["state"]), (len(digest), 1))
        state = compress(state, _text(digest))
        right = bytes.fromhex(step["right"])
        for sibling in (_unpacked(right) if right else ()):
            state = compress(state, np.tile(_text(sibling[None, :]), (len(state), 1)))
        digest = _closed(state, np.full(len(state), step["children"]))
    return digest


def _distinct(at: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows of the distinct (place, digest), and each row's number among them."""
    key = np.ascontiguousarray(np.concatenate([at[:, None].astype(np.uint32), digest], axis=1))
    _, first, back = np.unique(key.view("V36").ravel(), return_index=True, return_inverse=True)
    return first, back.ravel()


def _fold(arity: int, depth: int, out: T.StructType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Proof and folded root of every leaf of a chunk."""
    schema = _arrow(out)

    def fold(chunk: pa.Table, held: pa.Table) -> pa.Table:
        row = held.to_pylist()[0]
        chunk = chunk.sort_by("pos")
        nodes = _digests(chunk["digest"])
        levels = _levels(nodes, row, chunk["n"][0].as_py(), arity, depth)
        texts = [_hex(nodes), *(_hex(level.digests) for level in levels)]
        # siblings of each node, left and right of it, at every level of the chunk
        others = [[("".join(_siblings(level, texts[k], arity, i % arity, i // arity))).encode()
                   for i in range(len(texts[k]))] for k, level in enumerate(levels)]
        above = "".join(step["left"] + step["right"] for step in row["path"]).encode()
        proofs = []
        for i in range(len(nodes)):
            h, at = hashlib.sha256(), i
            for siblings in others:
                h.update(siblings[at])
                at //= arity
            h.update(above)
            proofs.append(h.hexdigest())

        # equal replacements at one place are folded once: above its lowest levels
        # a chunk holds few different ones
        now = _digests(chunk["now"])
        place, owner = np.arange(len(now)), np.arange(len(now))
        below = nodes
        for level in levels:
            parent, slot = place // arity, place % arity
            state = compress(_state_before(level, parent, slot), _text(now))
            for s in range(1, arity):
                there = np.flatnonzero((slot < s) & (level.children[parent] > s))
                if len(there):
                    state[there] = compress(state[there], _text(below[parent[there] * arity + s]))
            now, place, below = _closed(state, level.children[parent]), parent, level.digests
            first, back = _distinct(place, now)
            now, place, owner = now[first], place[first], back[owner]
        ends = np.array(_hex(folded(now, row["path"])), dtype=object)[owner]
        n = len(nodes)
        return pa.Table.from_arrays(
            [chunk["id"].combine_chunks().cast(schema.field(0).type), pa.array(texts[0]),
             pa.array([row["subroot"]] * n, pa.string()), pa.array([row["root"]] * n, pa.string()),
             pa.array(proofs, pa.string()), pa.array(ends, pa.string()),
             pa.array([x == row["root"] for x in ends], pa.bool_())], schema=schema)

    return fold


# ------------------------------------------------------------------ the manifest of a table
def _part(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: dict[str, Column]) -> Column:
    """The digest of a row, from its five columns."""
    return F.sha2(F.concat(*[_part(values[c]) for c in FIELDS]), 256)


def manifest(docs: DataFrame, replaced: Callable[[dict[str, Column]], dict[str, Column]] | None = None, *,
             arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for each row.

    ``replaced`` gives the columns as they are found when the manifest is checked (default:
    unchanged); ``folded_root`` is the root that the row then gives, and ``verified`` whether
    that is the manifest's.
    """
    if arity < 2 or depth < 1:
        raise ValueError("a parent has at least two children, a chunk at least one level")
    own = {c: of(docs, c) for c in FIELDS}
    found = replaced(own) if replaced else own
    # the ids' order has nulls first; the prefix keeps a null language before all others
    tree = F.coalesce(F.concat(F.lit("="), own["lang"]), F.lit("-"))
    rows = docs.select(tree.alias("tree"), own["doc_id"].alias("id"), leaf(own).alias("digest"),
                       leaf(found).alias("now"))
    placed = running_totals(rows, "tree", ["id", "digest"], F.lit(1), out="cum")
    placed = written(placed, "merkle-leaves")
    sizes = written(placed.groupBy("tree").agg(F.max("cum").alias("n")), "merkle-sizes")
    held = sizes.select(F.col("tree").alias("s_tree"), "n")
    if sizes.count() <= BROADCAST_TREES:
        held = F.broadcast(held)
    leaves = placed.join(held, placed["tree"] == held["s_tree"]).select(
        "tree", (F.col("cum") - 1).alias("pos"), "n", "id", "digest", "now")
    size = arity ** depth

    rounds = grown(leaves.select("tree", "pos", "n", "digest"), arity, depth)
    subroots = rounds[-1][1].select(F.lit("*").alias("all"), "tree", "digest")
    tops = running_totals(subroots, "all", ["tree"], F.lit(1), out="cum")
    tops = written(tops.select(F.lit("*").alias("tree"), (F.col("cum") - 1).alias("pos"), "digest",
                               F.col("tree").alias("of")), "merkle-tops")
    tops = tops.withColumn("n", F.lit(tops.count()).cast("long"))
    upper = grown(tops.select("tree", "pos", "n", "digest"), arity, depth)
    paths = upper[-1][1].select("tree", "pos", F.lit(None).cast("string").alias("subroot"),
                                F.col("digest").alias("root"), F.array().cast(T.ArrayType(STEP)).alias("path"))
    for nodes, above in reversed(upper):
        paths = _joined(nodes, above, paths, size, _descend(arity, depth), PATH)
    named = tops.select(F.col("pos").alias("t_pos"), "of", F.col("digest").alias("own"))
    paths = paths.join(named, paths["pos"] == named["t_pos"]).select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("own").alias("subroot"),
        "root", "path")
    paths = written(paths, "merkle-paths")
    for nodes, above in reversed(rounds[1:]):
        paths = _joined(nodes, above, paths, size, _descend(arity, depth), PATH)
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                        *[T.StructField(c, T.StringType()) for c in (
                            "leaf", "subroot", "root", "proof_sha256", "folded_root")],
                        T.StructField("verified", T.BooleanType())])
    return _joined(leaves, rounds[0][1], paths, size, _fold(arity, depth, out), out)


def tampered(values: dict[str, Column]) -> dict[str, Column]:
    """One more character claimed where 7 divides the checksum of the decimal id."""
    hit = F.crc32(values["doc_id"].cast("string").cast("binary")) % 7 == 0
    more = (values["n_chars"].cast("decimal(20,0)") + 1).cast("string")
    return values | {"n_chars": F.when(hit, more).otherwise(values["n_chars"].cast("string"))}
