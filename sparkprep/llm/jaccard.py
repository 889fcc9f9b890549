"""N-gram Jaccard join by parity sketches.

Two documents link when the Jaccard similarity of their shingle sets is at least
p / q. For sets of a and b shingles this means that their symmetric difference has at
most (q - p)(a + b) / (q + p) members.

* Parity sketch: each shingle flips one bit; XOR of two sketches is the sketch of the
  symmetric difference, so their Hamming distance never exceeds its size. Pairs whose
  distance is above the bound are dropped unread. A sketch has ``BITS`` bits at least and grows
  with the set, or large sets, which share a block by chance, would all be within their bound;
  of two lengths the longer is folded to the shorter, which is the sketch of that length.
* Pigeonhole join: per size band, shingles are dealt to k blocks by hash, with k above
  the largest difference allowed in the band, so two linked documents agree in a block.
  A block's parity is kept as the XOR of its shingles' 64-bit hashes (the linear
  image of a sketch of 2**64 bits), and equal block parities meet in a join. Empty
  blocks say nothing; ``k`` leaves room for the empty blocks expected. A pair is missed only
  if both documents have more of them, so each such document (one in some dozens) is dealt once
  more by another hash, and again, up to ``DEALINGS`` times: what is left after that (none in
  10^10) takes part with its empty blocks, so that no link is lost. Below a similarity of
  about 0.6 there is no room, and documents with empty blocks always take part with them.
* Verify: surviving pairs are compared shingle by shingle.

Steps and scale. Documents with equal shingle sets form a class at once (map-side
combined); one document per class goes on. Bucket rows (block parity, id) are shuffled
once; parities shared by very many documents, found on a sample of documents that
only routes rows, are combined map-side instead, so a hot bucket is never gathered.
Star round: each document is checked against the smallest document of its buckets,
which joins groups of near copies in linear work. Buckets whose members
are then still in several components are compared in full (of buckets with the same members, one):
members are dealt to chunks
of ``CHUNK``, and each pair of chunks is one unit of work that compares sketches in
NumPy and emits only pairs within the bound that are not joined yet: first a forest of
them, then, in buckets where a pair of the forest failed its check, all of them. Components come from alternating large-star
and small-star rounds over the edge table. Edges, components and sketches stay in
tables; the driver only reads counts. The tables go when the keys' classes are written, the block
parities, the largest, once the bucket rows are.
Texts and keys, the wide columns, are shuffled only for the rows a step asks for: before
each such join, broadcast bitmaps of hashed ids or sets (``sifted``) set aside the rows
that surely take no part. What a bitmap lets through in vain, the join drops.

Defined results: null and empty texts have no shingles and stay alone; a text of fewer
words than a shingle counts as one shingle of its whole word sequence; documents
with equal sets link (also copies); rows with a repeated id are documents of their own, each
compared by its own text, and so are rows with a null id; ids must be integers (a TypeError
otherwise); extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, exp, floor, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import of, passing, written
from sparkprep.session import ship_package

#: Least bits of a document's sketch, a power of two, kept as 64-bit words.
BITS = 1024
#: Largest size in a band over the smallest.
BAND = 1.4
#: Times that a document with many empty blocks is dealt before they take part.
DEALINGS = 6
#: Members of a mixed bucket that are compared in one unit with as many others.
CHUNK = 512
#: One document in HOT_SAMPLE is looked at for hot parities; those with HOT_COUNT
#: occurrences there, and a share of HOT_SHARE of the rows sampled, are routed apart.
HOT_SAMPLE, HOT_COUNT, HOT_SHARE = 32, 32, 1e-5
#: Bits of the bitmaps of ``sifted`` per distinct value, and at most (16 MB to broadcast); a
#: bitmap holds MAP_BITS, as Spark's ``bitmap_construct_agg`` does.
SIFT_BITS, SIFT_MOST, MAP_BITS = 64, 1 << 27, 1 << 15

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


@dataclass(frozen=True)
class Similarity:
    """Words per shingle, and the least similarity p / q."""

    words: int = 5
    p: int = 80
    q: int = 100

    def bound(self, a, b):
        """Largest symmetric difference of linked sets of a and b shingles."""
        return (self.q - self.p) * (a + b) // (self.q + self.p)

    def bits(self, n: int) -> int:
        """Length of the sketch of a set of n shingles. Unrelated sets differ in about half of so
        many bits, twice their bound: room for the members of a bucket, whose sizes differ."""
        return max(BITS, 1 << (4 * self.bound(n, n) - 1).bit_length())

    def partner(self, a: int) -> int:
        """Largest set that a set of a shingles can link with."""
        return a * self.q // self.p

    def band(self, n: int) -> int:
        """Band of a set of n shingles; bands are [edge(i), edge(i + 1))."""
        i = 0
        while self.edge(i + 1) <= n:
            i += 1
        return i

    @staticmethod
    def edge(i: int) -> int:
        n = 1
        for _ in range(i):
            n = max(n + 1, floor(n * BAND))
        return n

    def blocks(self, i: int) -> tuple[int, int]:
        """(k, empties): blocks for pairs whose smaller set is in band i, and how many of
        them a document may have empty without joining by its empty ones."""
        low, high = self.edge(i), self.edge(i + 1) - 1
        differences = self.bound(high, self.partner(high))
        if differences == 0:
            return 1, 0
        if low < differences + 2:  # no room for empty blocks: all take part
            return differences + 1, 0
        empties = 0
        while True:
            k = differences + 1 + empties
            # mean and deviation of the empty blocks after dealing ``low`` shingles
            none = exp(-low / k)
            enough = ceil(k * none + 2 * sqrt(k * none * max(0.0, 1 - (1 + low / k) * none)))
            if enough <= empties or k > 64 * low:
                return k, empties
            empties = max(empties + 1, min(enough, empties + 8))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles (A-Z lower-cased)."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    out = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        out = mix(out * _MIX[0] + h[k:len(h) - width + 1 + k])
    return np.unique(out)


def sketch(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity sketch as bits / 64 words."""
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def same_length(sketches: list[np.ndarray]) -> np.ndarray:
    """One row per sketch, each folded to the length of the shortest: that length's sketch."""
    width = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(s.reshape(-1, width), axis=0) for s in sketches])


class Parities:
    """Block parities of a set, for its own band and the band below it can link to."""

    def __init__(self, similarity: Similarity):
        self.similarity = similarity
        self.known: dict[int, tuple[int, list[tuple[int, int, int]]]] = {}

    def bands(self, n: int) -> list[tuple[int, int, int]]:
        s = self.similarity
        if n not in self.known:
            own, out = s.band(n), []
            for i in range(own, -1, -1):
                if i < own and s.partner(s.edge(i + 1) - 1) < n:
                    break
                out.append((i, *s.blocks(i)))
            self.known[n] = out
        return self.known[n]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        out = []
        for band, k, empties in self.bands(len(hashes)) if len(hashes) else ():
            for deal in range(DEALINGS):
                # the first dealing has the band's own hash, later ones further ones
                seed = band + 1 + deal * 4096
                own = mix(hashes + np.uint64(seed * int(_MIX[0]) % 2**64))
                block = ((own >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
                order = np.argsort(block, kind="stable")
                block, own = block[order], mix(own)[order]
                starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                parity = np.bitwise_xor.reduceat(own, starts)
                at = block[starts]
                many = k - len(at) > empties
                if many and (not empties or deal == DEALINGS - 1):
                    missing = np.setdiff1d(np.arange(k, dtype=np.uint64), at)
                    at = np.concatenate([at, missing])
                    parity = np.concatenate([parity, np.zeros(len(missing), np.uint64)])
                out.append(mix(parity + mix(at + np.uint64((seed - 1) << 32) + _MIX[1])))
                if not many or not empties:
                    break
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def features(docs: DataFrame, id_col: str, text_col: str, similarity: Similarity) -> DataFrame:
    """id, n (set size), set_a and set_b (128-bit hash of the set), sketch, keys."""
    ship_package(docs.sparkSession)
    out = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                        *[T.StructField(c, T.LongType()) for c in ("n", "set_a", "set_b")],
                        T.StructField("sketch", T.ArrayType(T.LongType())),
                        T.StructField("keys", T.ArrayType(T.LongType()))])

    def lists(parts: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parities = Parities(similarity)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                sets = [shingle_set(t, similarity.words) for t in piece.column(1).to_pylist()]
                a = np.array([np.add.reduce(mix(s)) for s in sets], np.uint64)
                b = np.array([np.bitwise_xor.reduce(mix(s + _MIX[2])) for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                     lists([sketch(s, similarity.bits(len(s))) for s in sets]),
                     lists([parities.keys(s) for s in sets])],
                    names=out.names)

    return docs.select(of(docs, id_col), of(docs, text_col)).mapInArrow(run, out)


def sifted(rows: DataFrame, columns: list[Column], wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(without, perhaps): the rows whose ``columns`` equal no row of ``wanted``, and the others.

    All rows that equal one are among ``perhaps``, with up to one in SIFT_BITS that do not while
    the bitmaps are below SIFT_MOST. No row is shuffled.
    """
    own = [of(wanted, c) for c in wanted.columns]
    many = wanted.agg(F.approx_count_distinct(F.xxhash64(*own))).first()[0]
    size = min(SIFT_MOST, max(MAP_BITS, 1 << (SIFT_BITS * many).bit_length()))

    def part(place: Column) -> Column:
        return F.shiftright(place, MAP_BITS.bit_length() - 1)

    def bit(place: Column) -> Column:
        return place.bitwiseAND(F.lit(MAP_BITS - 1))

    place = F.pmod(F.xxhash64(*own), F.lit(size))
    maps = wanted.select(place.alias("place")).groupBy(part(F.col("place")).alias("sift_part")).agg(
        F.bitmap_construct_agg(bit(F.col("place"))).alias("sift_bits"))
    maps = written(maps, "sift")
    place = F.pmod(F.xxhash64(*columns), F.lit(size))
    found = rows.join(F.broadcast(maps), part(place) == maps["sift_part"], "left")
    byte = F.substring(maps["sift_bits"], F.shiftright(bit(place), 3).cast("int") + 1, F.lit(1))
    there = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), bit(place).bitwiseAND(F.lit(7)).cast("int")) == 1
    there = F.coalesce(there, F.lit(False))
    same = [of(rows, c) for c in rows.columns]
    return found.where(~there).select(*same), found.where(there).select(*same)


def bucket_rows(reps: DataFrame) -> DataFrame:
    """(key, id, first): rows of the buckets with two members or more, ``first`` being the
    bucket's smallest id. Of buckets with the same members one is there, or some."""
    spark = reps.sparkSession
    rows = reps.select(F.explode("keys").alias("key"), "id")
    some = (reps.where(F.pmod(F.xxhash64("id"), F.lit(HOT_SAMPLE)) == 0)
            .select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    some = written(some.where(F.col("n") >= HOT_COUNT), "hot")
    sampled = some.agg(F.sum("n")).first()[0] or 0
    # at most 1 / HOT_SHARE keys can have that share, which bounds the broadcast
    hot = some.where(F.col("n") >= F.lit(HOT_SHARE * sampled)).select("key")
    from pyspark.sql import Window

    same = Window.partitionBy("key")
    # the members as a set of 128 bits and their number
    members = [F.bit_xor(F.xxhash64("id")), F.bit_xor(F.xxhash64("id", F.lit(1))), F.count(F.lit(1))]
    named = ("set_a", "set_b", "size")
    if not sampled:
        usual, often = rows, None
    else:
        usual = rows.join(F.broadcast(hot), "key", "left_anti")
        often = rows.join(F.broadcast(hot), "key", "left_semi")
    met = (usual.select("key", "id", F.count(F.lit(1)).over(same).alias("n"), F.min("id").over(same).alias("first"))
           .where("n > 1").drop("n"))
    met = met.select("*", *[m.over(same).alias(c) for m, c in zip(members, named)])
    if often is not None:
        firsts = often.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                          *[m.alias(c) for m, c in zip(members, named)])
        firsts = firsts.where("first <> last").drop("last")
        met = met.unionByName(often.join(F.broadcast(firsts), "key").select(*met.columns))
    met = written(met, "met")
    # a linked pair shares many of its parities, and each such bucket has the same pairs
    kept = written(met.where("id = first").groupBy(*named).agg(F.min("key").alias("key")).select("key"), "kept")
    return sifted(met.select("key", "id", "first"), [met["key"]], kept)[1]


def _hamming(a: str, b: str):
    """Hamming distance of two sketches, the longer folded to the shorter's length."""
    width = F.least(F.size(a), F.size(b))

    def folded(s: str) -> Column:
        def word(i: Column) -> Column:
            return F.aggregate(F.sequence(i, F.size(s) - 1, width), F.lit(0).cast("long"),
                               lambda x, at: x.bitwiseXOR(F.get(s, at)))
        return F.when(F.size(s) == width, F.col(s)).otherwise(F.transform(F.sequence(F.lit(0), width - 1), word))

    return F.aggregate(F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
                       lambda s, x: s + x)


def near(pairs: DataFrame, reps: DataFrame, similarity: Similarity) -> DataFrame:
    """The distinct pairs (a, b) whose sketches are within the bound of their sizes."""
    info = reps.select("id", "n", "sketch")
    both = (pairs.join(info.toDF("a", "n_a", "s_a"), "a").join(info.toDF("b", "n_b", "s_b"), "b"))
    total = F.col("n_a") + F.col("n_b")
    return both.where(_hamming("s_a", "s_b") * F.lit(similarity.q + similarity.p)
                      <= total * F.lit(similarity.q - similarity.p)).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, similarity: Similarity) -> DataFrame:
    """(a, b, linked): whole texts of both compared shingle by shingle."""
    pairs = written(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b"))
    texts = sifted(texts, [texts["id"]], ids)[1]
    both = (pairs.join(texts.toDF("a", "t_a"), "a").join(texts.toDF("b", "t_b"), "b")
            .select("a", "b", "t_a", "t_b"))
    out = T.StructType([*pairs.schema.fields, T.StructField("linked", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, np.empty(0, np.uint64)
        for batch in batches:
            linked = []
            for a, t_a, t_b in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if a != last:
                    last, known = a, shingle_set(t_a, similarity.words)
                other = shingle_set(t_b, similarity.words)
                same = len(np.intersect1d(known, other, assume_unique=True))
                linked.append(same * similarity.q >= (len(known) + len(other) - same) * similarity.p)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                                             names=out.names)

    return both.mapInArrow(run, out)


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of the nodes of edges (a, b): the smallest id reachable.

    Large-star joins each node's larger neighbours to its smallest one, small-star its
    smaller ones; both until nothing changes. Minima are combined map-side and joined
    back to the edges, so a node's neighbours are never gathered.
    """
    def minima(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "edges")
    known = state(edges)
    while known[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = both.join(minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = large.join(minima(large), "u")
        small = (small.select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
                 .where("a <> b").distinct())
        edges = written(small, "edges")
        now = state(edges)
        if now == known:
            break
        known = now
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return stars.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("label"))).distinct()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` (id, ...) with the label of each id (the id itself if it has none)."""
    named = labels.select(F.col("id").alias("l_id"), F.col("label").alias("l_label"))
    return (rows.join(named, rows["id"] == named["l_id"], "left")
            .withColumn("label", F.coalesce("l_label", "id")).drop("l_id", "l_label"))


def mixed_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, label, size) of the buckets whose members lie in several components."""
    named = _labelled(rows.select("key", "id"), labels)
    span = (named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                     F.count(F.lit(1)).alias("size")).where("lo <> hi").select("key", "size"))
    return named.join(span, "key")


def _near_pairs(n: np.ndarray, label: np.ndarray, chunk: np.ndarray, words: np.ndarray, across: bool,
                similarity: Similarity) -> Iterator[tuple[int, int]]:
    """Places (r, c) of the pairs of a unit in different components with sketches within
    the bound; rows come by chunk, and with ``across`` both must lie in different ones."""
    p, q, size = similarity.p, similarity.q, len(n)
    step = max(1, 4096 // size)
    for at in range(0, size - 1, step):
        r, c = np.nonzero(label[at:at + step, None] != label[None, :])
        r += at
        keep = r < c
        if across:
            keep &= chunk[r] != chunk[c]
        keep &= np.minimum(n[r], n[c]) * q >= np.maximum(n[r], n[c]) * p
        r, c = r[keep], c[keep]
        far = np.bitwise_count(words[r] ^ words[c]).sum(axis=1, dtype=np.int64)
        keep = far * (q + p) <= (n[r] + n[c]) * (q - p)
        yield from zip(r[keep].tolist(), c[keep].tolist())


def compared(mixed: DataFrame, reps: DataFrame, similarity: Similarity, forest: bool) -> DataFrame:
    """(key, a, b): pairs of a bucket in different components with sketches within the bound;
    with ``forest``, only enough of them to span what they connect in each unit."""
    info = reps.select(F.col("id").alias("f_id"), "n", "sketch")
    rows = mixed.join(info, mixed["id"] == info["f_id"]).drop("f_id")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    chunk = F.pmod(F.xxhash64("id", F.lit(7)), chunks).cast("int")
    rows = rows.withColumn("chunks", chunks).withColumn("chunk", chunk)
    # a unit is a pair of chunks; a chunk takes part in one unit per chunk of its bucket
    units = rows.select("key", "id", "label", "n", "sketch", "chunk", F.explode(
        F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    units = units.select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                         "chunk", "id", "label", "n", "sketch")
    # units lie one after the other in their partition: most are small, and a Python call
    # for each would cost more than its comparisons
    units = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "chunk")
    out = T.StructType([T.StructField("key", T.LongType()), T.StructField("a", reps.schema["id"].dataType),
                        T.StructField("b", reps.schema["id"].dataType)])

    def pairs_of(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        key, i, j, chunk, ids, label, n = (table.column(c).to_numpy() for c in (
            "key", "i", "j", "chunk", "id", "label", "n"))
        lists = table.column("sketch").combine_chunks()
        words = np.split(lists.flatten().to_numpy().view(np.uint64),
                         np.cumsum(pc.list_value_length(lists).to_numpy())[:-1])
        found: list[tuple] = []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            parent = {x: x for x in label[lo:hi].tolist()}
            if len(parent) < 2:
                continue

            def root(x):
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for r, c in _near_pairs(n[lo:hi], label[lo:hi], chunk[lo:hi], same_length(words[lo:hi]),
                                    i[lo] != j[lo], similarity):
                if forest:
                    x, y = root(label[lo + r].item()), root(label[lo + c].item())
                    if x == y:
                        continue
                    parent[max(x, y)] = min(x, y)
                a, b = ids[lo + r].item(), ids[lo + c].item()
                found.append((key[lo].item(), min(a, b), max(a, b)))
        kind = table.schema.field("id").type
        columns = list(zip(*found)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], kind),
                                           pa.array(columns[2], kind)], names=out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the unit that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            new = np.zeros(table.num_rows - 1, bool)
            for c in ("key", "i", "j"):
                v = table.column(c).to_numpy()
                new |= v[1:] != v[:-1]
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            held = table.slice(int(starts[-1]))
            if len(starts) > 1:
                yield pairs_of(table.slice(0, int(starts[-1])), starts)
        if held is not None:
            yield pairs_of(held, np.array([0, held.num_rows]))

    return units.mapInArrow(run, out)


def numbered(docs: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with a key of its own for every row in place of the id, and (key, own) of the
    rows whose key is not their id (None: every row's is).

    Rows whose id is null or repeated get surrogates above all ids; the rest is left alone.
    """
    own = of(docs, id_col)
    top, missing = docs.agg(F.max(own).cast("long"), F.count_if(own.isNull())).first()
    often = (docs.where(own.isNotNull()).groupBy(own.alias("r_id")).agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("r_id"))
    if not missing and often.isEmpty():
        return docs, None
    often = written(often, "often")
    top = max(top or 0, 0)
    if top >= 1 << 62:
        raise ValueError(f"no room for surrogates above {id_col} {top}")
    spare = "own"
    while spare in docs.columns:
        spare += "_"

    def with_id(rows: DataFrame, key: Column, *more: Column) -> DataFrame:
        return rows.select(*[(key if c == id_col else of(rows, c)).alias(c) for c in docs.columns], *more)

    once, perhaps = sifted(docs.where(own.isNotNull()), [own], often)
    again = of(perhaps, id_col) == often["r_id"]
    odd = docs.where(own.isNull()).unionAll(perhaps.join(often, again, "left_semi"))
    extra = written(with_id(odd, F.monotonically_increasing_id() + F.lit(top + 1), of(odd, id_col).alias(spare)),
                    "numbered")
    plain = once.unionAll(perhaps.join(often, again, "left_anti"))
    names = extra.select(of(extra, id_col).alias("key"), of(extra, spare).alias("own"))
    return with_id(plain, of(plain, id_col).cast("long")).unionAll(extra.drop(spare)), names


def _keyed(known: DataFrame, id_col: str, text_col: str, similarity: Similarity) -> DataFrame:
    """(key, n, label) of rows whose ids are keys, each there once: set size and the smallest
    key reachable. A written table."""
    with passing(known.sparkSession):
        return written(_labels(known, id_col, text_col, similarity), "labels", outlives=True)


def _labels(known: DataFrame, id_col: str, text_col: str, similarity: Similarity) -> DataFrame:
    """As ``_keyed``, over tables that are still there."""
    with passing(known.sparkSession):
        wide = written(features(known, id_col, text_col, similarity).withColumn("id", F.col("id").cast("long")),
                       "features")
        facts = written(wide.drop("keys"), "facts", outlives=True)
        sets = written(facts.where("n > 0").groupBy("set_a", "set_b", "n").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("members")), "sets", outlives=True)
        firsts = sets.select(F.col("rep").alias("id"))
        alone, perhaps = sifted(wide.where("n > 0"), [wide[c] for c in ("set_a", "set_b", "n")],
                                sets.where("members > 1").select("set_a", "set_b", "n"))
        rows = written(bucket_rows(alone.unionAll(perhaps.join(firsts, "id", "left_semi"))), "buckets",
                       outlives=True)
    texts = known.select(of(known, id_col).cast("long").alias("id"), of(known, text_col).alias("text"))
    stars = rows.where("id <> first").groupBy("id").agg(F.min("first").alias("first"))
    stars = stars.select(F.col("first").alias("a"), F.col("id").alias("b"))
    done = written(verified(near(stars, facts, similarity), texts, similarity), "checked")
    edges = done.where("linked").select("a", "b")
    labels = components(edges)
    for forest in (True, False):
        mixed = written(mixed_rows(rows, labels), "mixed")
        if mixed.isEmpty():
            break
        near_pairs = written(compared(mixed, facts, similarity, forest).distinct(), "near")
        pairs = near_pairs.select("a", "b").distinct().join(done, ["a", "b"], "left_anti")
        done = done.unionByName(written(verified(pairs, texts, similarity), "checked"))
        edges = done.where("linked").select("a", "b")
        labels = components(edges)
        # where all pairs of a bucket's forest link, all its near pairs are joined by now:
        # only buckets with a pair that does not link are compared in full
        open_keys = near_pairs.join(done.where("not linked"), ["a", "b"], "left_semi").select("key").distinct()
        rows = rows.join(open_keys, "key", "left_semi")
    named = _labelled(sets.withColumn("id", F.col("rep")), labels).select(
        F.col("set_a").alias("c_a"), F.col("set_b").alias("c_b"), F.col("n").alias("c_n"), "label")
    out = facts.join(named, (facts["set_a"] == named["c_a"]) & (facts["set_b"] == named["c_b"])
                     & (facts["n"] == named["c_n"]) & (facts["n"] > 0), "left")
    return out.select(F.col("id").alias("key"), "n", F.coalesce("label", "id").alias("label"))


def _checked(docs: DataFrame, id_col: str) -> None:
    if not isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType)):
        raise TypeError(f"{id_col} must be an integer column")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            similarity: Similarity = Similarity()) -> DataFrame:
    """id, n_shingles and component_id (the smallest id reachable by links) per document.

    component_id is null where no document with an id is reachable.
    """
    _checked(docs, id_col)
    known, names = numbered(docs.select(of(docs, id_col).alias(id_col), of(docs, text_col).alias(text_col)), id_col)
    out = _keyed(known, id_col, text_col, similarity)
    if names is None:
        return out.select(F.col("key").alias(id_col), F.col("n").alias("n_shingles"),
                          F.col("label").alias("component_id"))
    out = written(_owned(out, names), "keyed")
    least = out.groupBy("label").agg(F.min("own").alias("component_id")).withColumnRenamed("label", "c_label")
    return (out.join(least, out["label"] == least["c_label"])
            .select(F.col("own").alias(id_col), F.col("n").alias("n_shingles"), "component_id"))


def _owned(keyed: DataFrame, names: DataFrame) -> DataFrame:
    """``keyed`` with each row's own id, null or repeated as it may be."""
    other = names.select(F.col("key").alias("n_key"), F.col("own").alias("n_own"))
    return keyed.join(other, keyed["key"] == other["n_key"], "left").withColumn(
        "own", F.when(F.col("n_key").isNull(), F.col("key")).otherwise(F.col("n_own"))).drop("n_key", "n_own")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 similarity: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs`` that stay: of each class of linked rows the one with the smallest id
    (null ids last); of several with that id, one."""
    _checked(docs, id_col)
    kind = docs.schema[id_col].dataType
    known, names = numbered(docs, id_col)
    found = _keyed(known, id_col, text_col, similarity)
    if names is None:
        return _without(known, id_col, found.where("label <> key").select("key"))
    found = written(_owned(found, names), "keyed")
    first = found.groupBy("label").agg(F.min(F.struct(F.col("own").isNull().alias("none"), "own", "key")).alias("f"))
    stay = first.select(F.col("f.key").alias("s_key"))
    kept = _without(known, id_col, found.join(stay, found["key"] == stay["s_key"], "left_anti").select("key"))
    names = written(names.select(F.col("key").alias("n_key"), F.col("own").alias("n_own")), "names")
    plain, perhaps = sifted(kept, [of(kept, id_col)], names.select("n_key"))
    odd = perhaps.join(names, of(perhaps, id_col) == names["n_key"], "left")
    own = F.when(names["n_key"].isNull(), of(perhaps, id_col)).otherwise(names["n_own"])
    return plain.select(*[of(plain, c).cast(kind).alias(c) if c == id_col else of(plain, c)
                          for c in docs.columns]).unionAll(odd.select(
        *[own.cast(kind).alias(c) if c == id_col else of(perhaps, c) for c in docs.columns]))


def _without(rows: DataFrame, id_col: str, keys: DataFrame) -> DataFrame:
    """``rows`` but those whose id is in ``keys`` (key)."""
    gone = written(keys.select(F.col("key").alias("gone")), "gone")
    stay, perhaps = sifted(rows, [of(rows, id_col).cast("long")], gone)
    return stay.unionAll(perhaps.join(gone, of(perhaps, id_col) == gone["gone"], "left_anti"))
