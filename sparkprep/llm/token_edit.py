"""Token counts that follow edits.

A document's state is a segment tree over its pre-tokens: leaves of about ``LEAF``
pre-tokens hold their characters and tokens, inner nodes the sums of their
children. Edits descend the tree to the leaves they touch, split the text anew
from the last leaf border that cannot see the edit until a new border meets an old
leaf border again, re-encode that stretch only, and update the sums above. Trees
leave with the result and come back in with the next edits (``tree_col``), so a
document is encoded as a whole only once.

Added tokens count as one token each, as in ``bpe``. Splitting looks at most two
characters past a pre-token and an added token's length past its first character, and
never behind a border, so borders that far before an edit stand, and splits agree from
the first common border behind it. All edits of a document are applied in one pass
over its text.

Defined results: null texts count as empty (0 tokens); edits are (start, end,
replacement) in code points of the text before all edits, with a null or empty list
for none and a null replacement for an empty one; edits that lack a place, are unsorted,
overlap or leave the text change nothing, and ``refused`` says why (null otherwise);
a kept tree that is null or does not belong to the text is built anew; repeated rows each
get their result, and an empty table has none; other columns are not looked at,
whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.bpe import Encoder, broadcast_vocabulary, worker_encoder
from sparkprep.llm.common import of

#: Pre-tokens per leaf when a tree is built; it gets more leaves once edits give some four
#: times as many.
LEAF = 64


class TokenTree:
    """Sums of characters and tokens over leaves; ``chars[1]`` and ``tokens[1]`` are totals."""

    def __init__(self, leaf_chars: list[int], leaf_tokens: list[int]):
        self.used = max(1, len(leaf_chars))
        self.n = 1 << (self.used - 1).bit_length()
        self.chars, self.tokens = self._sums(leaf_chars), self._sums(leaf_tokens)

    def _sums(self, leaves: list[int]) -> list[int]:
        out = [0] * self.n + list(leaves) + [0] * (self.n - len(leaves))
        for i in range(self.n - 1, 0, -1):
            out[i] = out[2 * i] + out[2 * i + 1]
        return out

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaves(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves, from which the tree is built again."""
        return tuple(x[self.n:self.n + self.used] for x in (self.chars, self.tokens))

    def find(self, at: int) -> tuple[int, int, int]:
        """Leaf holding character ``at`` (the last one at the end), its start and its end."""
        i, start = 1, 0
        while i < self.n:
            i *= 2
            if at >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.n, start, start + self.chars[i]

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Sets a leaf and updates the sums above it."""
        i = self.n + leaf
        dc, dt = chars - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += dc
            self.tokens[i] += dt
            i //= 2


def refusal(edits: list[tuple], size: int) -> str | None:
    """Why a list of edits cannot be applied to a text of ``size`` characters."""
    reach = 0
    for start, end, _ in edits:
        if start is None or end is None:
            return "an edit lacks its place"
        if not 0 <= start <= end <= size:
            return f"edit {start}:{end} leaves the text"
        if start < reach:
            return f"edit {start}:{end} begins before the end of another"
        reach = end
    return None


def replaced(text: str, begin: int, stop: int, edits: list[tuple[int, int, str]]) -> str:
    """text[begin:stop] with the edits that lie in it."""
    out = []
    for start, end, new in edits:
        out += [text[begin:start], new]
        begin = end
    return "".join([*out, text[begin:stop]])


class EditCounter:
    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        #: Characters before and behind an edit that may see it.
        self.sight = 3 + max(map(len, encoder.added), default=0)
        #: Whether a text with added tokens was met; units are looked through for them only then.
        self.met_added = False

    def units(self, text: str) -> list[str]:
        """Pre-tokens and added tokens of a text."""
        encoder = self.encoder
        if encoder.special is None or not any(t in text for t in encoder.added):
            return encoder.split(text)
        self.met_added = True
        return [u for p in encoder.special.split(text) for u in ([p] if p in encoder.added else encoder.split(p))]

    def _count(self, units: list[str]) -> int:
        added = self.encoder.added
        if self.met_added and not added.keys().isdisjoint(units):
            plain = [u for u in units if u not in added]
            return len(units) - len(plain) + self._count(plain)
        return sum(map(len, map(self.encoder.words.__getitem__, units))) // 4

    def _leaves(self, units: list[str], size: int) -> tuple[list[int], list[int]]:
        parts = [units[i:i + size] for i in range(0, len(units), size)]
        return [sum(map(len, p)) for p in parts], [self._count(p) for p in parts]

    def build(self, text: str) -> TokenTree:
        return TokenTree(*self._leaves(self.units(text), LEAF))

    def stretch(self, tree: TokenTree, text: str, edits: list[tuple[int, int, str]],
                at: int) -> tuple[int, int, int, list[str]]:
        """What the edits from ``at`` on change together: the next edit, the first and last
        leaf, and the units that these leaves hold afterwards."""
        first, begin, _ = tree.find(max(0, edits[at][0] - self.sight))
        last, _, stop = tree.find(edits[at][1])
        upto, more = at + 1, 1
        while True:
            while upto < len(edits) and edits[upto][0] - self.sight < stop:
                leaf, _, end = tree.find(edits[upto][1])
                last, stop, upto = max(last, leaf), max(stop, end), upto + 1
            new = replaced(text, begin, stop, edits[at:upto])
            if stop >= len(text):
                return upto, first, tree.used - 1, self.units(new)
            units = self.units(new + text[stop:stop + self.sight])
            ends = list(accumulate(map(len, units)))
            hit = bisect_left(ends, len(new))
            if not new:  # the border at the stretch's own start stands
                return upto, first, last, []
            if hit < len(ends) and ends[hit] == len(new):
                return upto, first, last, units[:hit + 1]
            for _ in range(more):  # no border of the new split there: further leaves
                if last + 1 < tree.used:
                    last += 1
                    stop += tree.chars[tree.n + last]
            more *= 2

    def edited(self, text: str, edits: list[tuple[int, int, str]],
               tree: TokenTree | None = None) -> tuple[int, TokenTree, int, str]:
        """Tokens before the edits, the tree after them, characters encoded again for
        them, and the new text. Edits are sorted and disjoint; ``tree`` is used up."""
        tree = tree or self.build(text)
        before, again, at, changes = tree.total, 0, 0, []
        while at < len(edits):
            at, first, last, units = self.stretch(tree, text, edits, at)
            changes.append((first, last, units))
            again += sum(map(len, units))
        if any(len(units) > 4 * LEAF * (last - first + 1) for first, last, units in changes):
            chars, tokens = tree.leaves()
            for first, last, units in reversed(changes):
                chars[first:last + 1], tokens[first:last + 1] = self._leaves(units, LEAF)
            tree = TokenTree(chars, tokens)
        else:
            for first, last, units in changes:
                share = max(1, -(-len(units) // (last - first + 1)))
                chars, tokens = self._leaves(units, share)
                for k in range(last - first + 1):
                    tree.put(first + k, *((chars[k], tokens[k]) if k < len(chars) else (0, 0)))
        return before, tree, again, replaced(text, 0, len(text), edits)


EDITS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("text", T.StringType())]))
#: A kept tree: its leaves, and the checksum of the text it belongs to.
TREE = T.StructType([T.StructField("chars", T.ArrayType(T.IntegerType())),
                     T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("crc", T.LongType())])


def kept_tree(row: dict | None, text: str) -> TokenTree | None:
    """The tree of a kept row, if it belongs to the text."""
    if not row or not row["chars"] or row["crc"] != zlib.crc32(text.encode()):
        return None
    return TokenTree(row["chars"], row["tokens"])


def counted(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
            edits_col: str = "edits", tree_col: str | None = None) -> DataFrame:
    """id, n_tokens, n_edits, n_tokens_edited, n_chars_again, edited_text, refused and
    tree (of the edited text) per document.

    ``edits_col`` is an array<struct<start, end, text>>; ``tree_col`` holds the trees that
    an earlier call returned for these texts. Both travel with the document's row, so
    nothing is shuffled.
    """
    shared = broadcast_vocabulary(docs.sparkSession, path)
    names = ["n_tokens", "n_edits", "n_tokens_edited", "n_chars_again"]
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                        *[T.StructField(n, T.LongType()) for n in names],
                        T.StructField("edited_text", T.StringType()), T.StructField("refused", T.StringType()),
                        T.StructField("tree", TREE)])
    kept = of(docs, tree_col) if tree_col else F.lit(None).cast(TREE)
    kind = pa.struct([("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32())), ("crc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = EditCounter(worker_encoder(shared))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                rows = []
                for text, edits, tree in zip(*(piece.column(i).to_pylist() for i in (1, 2, 3))):
                    text = text or ""
                    todo = [(e and e["start"], e and e["end"], e and e["text"] or "") for e in edits or []]
                    no = refusal(todo, len(text))
                    before, tree, again, new = counter.edited(text, [] if no else todo, kept_tree(tree, text))
                    chars, tokens = tree.leaves()
                    rows.append((before, len(todo), tree.total, again, new, no,
                                 {"chars": chars, "tokens": tokens, "crc": zlib.crc32(new.encode())}))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]],
                     *[pa.array(c, pa.string()) for c in cols[4:6]], pa.array(cols[6], kind)], names=out.names)

    return docs.select(of(docs, id_col), of(docs, text_col), of(docs, edits_col),
                       kept.alias("tree")).mapInArrow(run, out)


#: What cleaning replaces: e-mail addresses, IPv4 addresses, long numbers and keys.
PRIVATE = regex.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{9,}\b|\b[0-9a-f]{24,}\b")


def cleaning_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and the edits of a cleaning pass: private strings become ``[removed]``, and
    lines equal to an earlier line are deleted."""
    from sparkprep.session import ship_package

    ship_package(docs.sparkSession)
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                        T.StructField(text_col, T.StringType()), T.StructField("edits", EDITS)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))

    def edits_of(text: str) -> list[dict]:
        out, seen, at = [], set(), 0
        for line in text.split("\n"):
            if line and line in seen:  # with the line break before it
                out.append({"start": at - 1, "end": at + len(line), "text": ""})
            else:
                seen.add(line)
                out += [{"start": at + m.start(), "end": at + m.end(), "text": "[removed]"}
                        for m in PRIVATE.finditer(line)]
            at += len(line) + 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = [edits_of(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(edits, kind)],
                                             names=out.names)

    return docs.select(of(docs, id_col), of(docs, text_col)).mapInArrow(run, out)
