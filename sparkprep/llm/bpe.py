"""BPE encoding and decoding by the backtracking encoder.

A byte-level BPE vocabulary is read once on the driver (its size is checked) and
broadcast. In each Python worker it becomes:

* an Aho-Corasick automaton over the reversed tokens: one pass over a reversed
  pre-token gives the longest token starting at each of its bytes;
* the pair-compatibility table: whether two adjacent tokens can both survive the
  merges. A pair is compatible when no merge of lower rank crosses the border, which
  is decided by unfolding the merge halves at the border and kept per pair;
* for decoding, one byte string of all tokens and a table of offsets, gathered with
  NumPy.

The encoder takes the longest token at each place whose pair with the previous token
is compatible, and otherwise falls back to the next shorter token or drops the
previous one; places found dead are marked, so each byte is settled once. The result
is exactly that of applying the merges in order, in time linear in the text.

Texts are split by the vocabulary's pattern as the ``tokenizers`` library does:
added tokens first, then words. Characters that the installed ``regex`` knows as
letters or digits and the library does not (newer Unicode) are found by asking the
library, and treated as it does.

Defined results: null and empty texts give no ids and an empty decoded text; nothing
is cut, however long; repeated rows each get their result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import of
from sparkprep.session import ship_package

#: Vocabulary files beyond this size are refused rather than broadcast.
MAX_VOCABULARY_BYTES = 64 << 20
#: Pre-tokens and token pairs remembered per worker.
CACHE_WORDS, CACHE_PAIRS = 500_000, 500_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def unknown_to_library() -> str:
    """The characters (as ranges of a character class) that ``regex`` takes as letters
    or digits but the ``tokenizers`` library does not."""
    from tokenizers import pre_tokenizers

    known = regex.compile(r"[\p{L}\p{N}]")
    chars = [c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if known.match(c)]
    spans = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(
        "".join("." + c for c in chars))
    starts = {a for _, (a, _) in spans}
    new = [ord(c) for i, c in enumerate(chars) if 2 * i + 1 not in starts]
    ranges: list[list[int]] = []
    for n in new:
        if ranges and ranges[-1][1] == n - 1:
            ranges[-1][1] = n
        else:
            ranges.append([n, n])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> dict:
    """What workers need of a byte-level BPE ``tokenizer.json``: tokens by id, merges in
    order as id triples (left, right, merged), added tokens, and the unknown characters."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if (spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel"
            or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    alphabet, ids = byte_alphabet(), spec["model"]["vocab"]
    tokens = {i: bytes(alphabet[c] for c in t) for t, i in ids.items()}
    added = {a["content"]: a["id"] for a in spec["added_tokens"]}
    tokens.update({i: t.encode() for t, i in added.items()})
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return {"key": f"{path}:{os.path.getsize(path)}:{os.path.getmtime(path)}", "tokens": tokens,
            "added": added, "unknown": unknown_to_library(),
            "merges": [(ids[a], ids[b], ids[a + b]) for a, b in pairs]}


class _Words(dict):
    """Ids (as little-endian 32-bit bytes) of the pre-tokens met lately: when full, the
    words met since the last time stay."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.old = encoder, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.encoder.word_ids(word)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found


class Encoder:
    """Backtracking BPE over one vocabulary; tokens are numbered by merge rank inside."""

    def __init__(self, vocabulary: dict):
        import ahocorasick

        merges, tokens = vocabulary["merges"], vocabulary["tokens"]
        made = {m for _, _, m in merges}
        added = set(vocabulary["added"].values())
        singles = [i for i, t in tokens.items() if len(t) == 1 and i not in made | added]
        order = sorted(singles, key=lambda i: tokens[i]) + [m for _, _, m in merges]
        if len(set(order)) != len(order):
            raise ValueError("a token is made by more than one merge")
        rank = {i: r for r, i in enumerate(order)}
        self.id_bytes = [i.to_bytes(4, "little") for i in order]
        self.bytes = [tokens[i] for i in order]
        self.halves = [(r, r) for r in range(len(singles))] + [(rank[a], rank[b]) for a, b, _ in merges]
        self.merged = {(rank[a], rank[b]): rank[m] for a, b, m in merges}
        self.sizes = [len(t) for t in self.bytes]
        self.by_bytes = {t: r for r, t in enumerate(self.bytes)}
        self.automaton = ahocorasick.Automaton()
        for r, t in enumerate(self.bytes):
            self.automaton.add_word(t[::-1].decode("latin-1"), r)
        self.automaton.make_automaton()
        #: The longest shorter token with which a token begins, -1 if none.
        self.shorter = [next((self.by_bytes[t[:n]] for n in range(len(t) - 1, 0, -1)
                              if t[:n] in self.by_bytes), -1) for t in self.bytes]
        self.pairs: dict[int, bool] = {}
        self.words = _Words(self)
        self.added = vocabulary["added"]
        new = vocabulary["unknown"]
        # below this code point the standard module's plain sets do, and are faster
        top = int(new[2:10], 16) if new else 0x500
        self.high = re.compile(f"[\\U{top:08x}-\\U0010ffff]")
        low_l, low_n, low_s = ("".join(f"\\U{i:08x}" for i in range(top) if regex.match(c, chr(i)))
                               for c in (r"\p{L}", r"\p{N}", r"\s"))
        self.low = re.compile(rf" ?[{low_l}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{low_n}]+| ?[^{low_s}{low_l}{low_n}]+"
                              rf"|[{low_s}]+(?![^{low_s}])|[{low_s}]+")
        letters, digits = (rf"[\p{{{c}}}--[{new}]]" if new else rf"\p{{{c}}}" for c in "LN")
        other = rf"(?:[^\s\p{{L}}\p{{N}}]|[{new}])" if new else r"[^\s\p{L}\p{N}]"
        self.careful = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}+| ?{digits}+| ?{other}+|\s+(?!\S)|\s+", regex.V1)
        self.special = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        size = max(tokens) + 1
        lengths = np.zeros(size, np.int64)
        for i, t in tokens.items():
            lengths[i] = len(t)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.blob = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges can leave ``left`` and ``right`` side by side."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        # undo the later of the two merges at the border, again and again; a merge of the
        # border pieces that came before the merge last undone would have crossed the border
        n = len(self.halves)
        bound = n
        while True:
            crossing = self.merged.get((a, b))
            if crossing is not None and crossing < bound:
                return False
            left, right = self.halves[a], self.halves[b]
            if a > b:
                if left[0] != left[1] or len(self.bytes[a]) > 1:
                    bound, a = a, left[1]
                    continue
                if len(self.bytes[b]) == 1:
                    return True
                bound, b = b + 1, right[0]
            else:
                if len(self.bytes[b]) > 1:
                    bound, b = b + 1, right[0]
                    continue
                if len(self.bytes[a]) == 1:
                    return True
                bound, a = a, left[1]

    def encode_word(self, word: bytes) -> list[int]:
        """Ranks of the tokens of one pre-token."""
        whole = self.by_bytes.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        # by distance from the end; of matches at one place the longest comes first
        longest = dict(reversed(list(self.automaton.iter(word[::-1].decode("latin-1")))))
        open_, sizes = bytearray(b"\x01") * (n + 1), self.sizes
        out: list[int] = []
        at, token, last, known = 0, longest[n - 1], -1, self.pairs.get
        while at < n:
            end = at + sizes[token]
            fits = open_[end]
            if fits and last >= 0:
                fits = known(last << 32 | token)
                if fits is None:
                    fits = self.compatible(last, token)
            if fits:
                out.append(token)
                at, last = end, token
                if at < n:
                    token = longest[n - 1 - at]
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:  # nothing fits here: close the place and retry the previous token
                open_[at] = 0
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1
        return out

    def word_ids(self, word: str) -> bytes:
        return b"".join(map(self.id_bytes.__getitem__, self.encode_word(word.encode())))

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text without added tokens."""
        if text.isascii() or not self.high.search(text):
            return self.low.findall(text)
        return self.careful.findall(text)

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text, as int32."""
        parts = [text]
        if self.special is not None and any(t in text for t in self.added):
            parts = self.special.split(text)
        get, added = self.words.__getitem__, self.added
        pieces = [added[p].to_bytes(4, "little") if p in added
                  else b"".join(map(get, self.split(p))) for p in parts]
        return np.frombuffer(b"".join(pieces), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of all tokens by the offset table, read as UTF-8 (bad bytes replaced)."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
        return self.blob[places].tobytes().decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(shared) -> Encoder:
    """The worker's encoder for a broadcast vocabulary (built once per process)."""
    key = shared.value["key"]
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def broadcast_vocabulary(spark, path: str):
    ship_package(spark)
    return spark.sparkContext.broadcast(load_vocabulary(path))


def _field(df: DataFrame, name: str, alias: str) -> T.StructField:
    return T.StructField(alias, df.schema[name].dataType, True)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids array<int> and decoded text of every document."""
    shared = broadcast_vocabulary(docs.sparkSession, path)
    out = T.StructType([_field(docs, id_col, id_col), T.StructField("ids", T.ArrayType(T.IntegerType())),
                        T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                ids = [encoder.encode(t or "") for t in piece.column(1).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                texts = pa.array([encoder.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([piece.column(0), lists, texts], names=out.names)

    return docs.select(of(docs, id_col), of(docs, text_col)).mapInArrow(run, out)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (little-endian 32-bit ids) and decoded_sha256."""
    done = encoded(docs, path, id_col, text_col)
    out = T.StructType([_field(docs, id_col, id_col), T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            ends = lists.offsets.to_numpy()
            shas = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.array(shas, pa.string()),
                 batch.column(2)], names=out.names)

    return done.select(id_col, "ids", F.sha2("decoded", 256)).mapInArrow(run, out)
