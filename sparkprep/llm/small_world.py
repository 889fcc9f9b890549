"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Vectors link when their cosine, in double precision, is at least the threshold. The distinct
vectors are dealt over shards by a hash; each shard builds a graph of its own, every vector is
searched in every shard, what is found is verified in double precision, and the links'
components are joined.

* Graph. A node's top layer falls geometrically with a hash of its id; layer 0 holds all nodes.
  Nodes enter in batches, in the order of their top layers: a batch descends greedily through the
  finished layers above, runs a beam search among the nodes already there, compares itself with the
  rest of its batch, and links to its nearest candidates that are not closer to one already chosen.
  Links are returned; a full list is chosen anew by the same rule. A node that nobody links to at the
  end replaces the last link of its nearest neighbour.
* Search. All queries of a block advance at once: each step expands the best ``WIDTH`` open nodes of
  every beam. Every node met at or above the threshold is a hit whether or not it stays in the beam,
  and hits are expanded until no new one appears, so a group larger than the beam is found whole.
* Audit. Each shard turns a sample of its own vectors by almost the threshold's angle into a hashed
  direction, searches them, and compares with brute force over the shard. The beam is doubled until
  the share found reaches ``RECALL``; a shard that does not get there with ``BEAM_MOST`` is
  compared by brute force. The sample (``AUDIT`` vectors a shard) only sets the width.
* Scale. A pair of shards is one task (the vectors of one in the graph of the other, each pair once);
  a shard holds ``SHARD_BYTES`` of vectors at most, so no task grows with the table. A task returns a
  number of links for each vector and a spanning forest of its links, never the pairs: a group of g
  near copies costs g rows in each task it meets. Searching every shard is the method: work grows in
  proportion to the table while ``SHARDS`` shards hold it and with its square over SHARD_BYTES beyond.
  Nothing is broadcast; tables between the steps lie in the shared folder.

Defined results: vectors that are null, empty, all zero or hold null or non-finite entries link with
nothing; vectors of different lengths do not link; equal vectors are searched once and
count as links of each other; repeated ids are rows of their own, each with its links and all
with the component's smallest id; a null id is never the smallest, so a component without ids has
component_id null (and its rows are kept); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import of, written
from sparkprep.llm.jaccard import components
from sparkprep.session import ship_package

#: Shards at least, and bytes of vectors (as doubles) that a shard holds at most.
SHARDS, SHARD_BYTES = 8, 128 << 20
#: Links of a node above layer 0 (twice as many in it); beam while building; nodes expanded per step.
LINKS, BEAM_BUILD, WIDTH = 12, 48, 4
#: Nodes of the layer above from which a beam enters the next.
ENTRIES = 8
#: First and widest beam of a search, audited vectors of a shard, and the share that must be found.
BEAM, BEAM_MOST, AUDIT, RECALL = 32, 1024, 256, 0.995
BATCH = 1024
#: Marks (4 bytes a query and node) that a block of queries may take.
MARKS = 48 << 20
SLACK = 1e-5  # single precision against double


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 mixed bits of each whole number (the finaliser of splitmix64)."""
    z = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision, without overflow of large entries."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _dots(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), x.dtype)
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[s] = np.einsum("ij,ij->i", x[i[s]], y[j[s]])
    return out


# ------------------------------------------------------------------ searching one layer
@dataclass
class _Search:
    """Beams of a block of queries over one layer's links."""
    x: np.ndarray
    links: np.ndarray
    q: np.ndarray
    least: float = np.inf
    marks: np.ndarray = field(init=False)
    found: list = field(default_factory=list)

    def __post_init__(self) -> None:
        self.marks = np.zeros((len(self.q), len(self.links)), np.int32)

    def _met(self, row: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs not met before, once each, with their similarity; hits are noted."""
        new = (node >= 0) & (self.marks[row, node] == 0)
        row, node = row[new], node[new]
        stamp = np.arange(1, len(row) + 1, dtype=np.int32)
        self.marks[row, node] = stamp
        once = self.marks[row, node] == stamp
        row, node = row[once], node[once]
        sim = _dots(self.x, node, self.q, row)
        hit = sim >= self.least
        if hit.any():
            self.found.append((row[hit], node[hit]))
        return row, node, sim

    def beam(self, entry: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and similarities (queries, size), best first, of the beams from the entry nodes
        (queries, e), -1 for none; nodes beyond ``size`` are left out."""
        n = len(self.q)
        entry = entry[:, :size].astype(np.int64)
        wide = entry.shape[1]
        ids = np.full((n, size), -1, np.int64)
        sims = np.full((n, size), -np.inf, self.x.dtype)
        open_ = np.zeros((n, size), bool)
        rows = np.arange(n)
        row, node, sim = self._met(rows.repeat(wide), entry.ravel())
        place = np.arange(len(row)) - np.searchsorted(row, row)
        ids[row, place], sims[row, place], open_[row, place] = node, sim, True
        width = min(WIDTH, size)
        while len(rows):
            masked = np.where(open_[rows], sims[rows], -np.inf)
            pick = (np.argpartition(-masked, width - 1, axis=1)[:, :width] if width < size
                    else np.tile(np.arange(size), (len(rows), 1)))
            live = np.take_along_axis(masked, pick, axis=1) > -np.inf
            r, c = rows[:, None].repeat(width, 1)[live], pick[live]
            open_[r, c] = False
            node = ids[r, c]
            self.marks[r, node] = -1  # expanded
            wide = self.links.shape[1]
            row, new, sim = self._met(r.repeat(wide), self.links[node].ravel().astype(np.int64))
            better = sim > sims[row].min(axis=1) if len(row) else np.zeros(0, bool)
            row, new, sim = row[better], new[better], sim[better]
            if len(row):
                count = np.bincount(row, minlength=n)
                some = np.flatnonzero(count)
                place = np.arange(len(row)) - (np.cumsum(count) - count)[row]
                order = np.argsort(row, kind="stable")
                row, new, sim = row[order], new[order], sim[order]
                at = np.searchsorted(some, row)
                most = int(count.max())
                pad_ids = np.full((len(some), most), -1, np.int64)
                pad_sims = np.full((len(some), most), -np.inf, self.x.dtype)
                pad_ids[at, place], pad_sims[at, place] = new, sim
                all_ids = np.concatenate([ids[some], pad_ids], axis=1)
                all_sims = np.concatenate([sims[some], pad_sims], axis=1)
                all_open = np.concatenate([open_[some], pad_ids >= 0], axis=1)
                keep = np.argpartition(-all_sims, size - 1, axis=1)[:, :size]
                ids[some] = np.take_along_axis(all_ids, keep, axis=1)
                sims[some] = np.take_along_axis(all_sims, keep, axis=1)
                open_[some] = np.take_along_axis(all_open, keep, axis=1)
            rows = rows[open_[rows].any(axis=1)]
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)

    def hits(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs at or above the threshold: hits are expanded until no new one appears."""
        empty = np.zeros(0, np.int64)
        done = 0
        while done < len(self.found):
            row, node = self.found[done]
            done += 1
            left = self.marks[row, node] >= 0
            row, node = row[left], node[left]
            self.marks[row, node] = -1
            step = max(1, (1 << 20) // self.links.shape[1])
            for at in range(0, len(row), step):
                s = slice(at, at + step)
                self._met(row[s].repeat(self.links.shape[1]), self.links[node[s]].ravel().astype(np.int64))
        if not self.found:
            return empty, empty
        return (np.concatenate([r for r, _ in self.found]), np.concatenate([c for _, c in self.found]))


# ------------------------------------------------------------------ one shard's graph
def _chosen(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (best first, -1: none), up to ``most`` of which none is closer to one
    chosen before it than to the row's node; free places go to the best of the rest."""
    out = np.full((len(ids), most), -1, np.int32)
    for at in range(0, len(ids), 512):
        i, s = ids[at:at + 512], sims[at:at + 512]
        v = x[i]
        among = v @ v.transpose(0, 2, 1)
        near = np.full(i.shape, -np.inf, x.dtype)
        took = np.zeros(i.shape, bool)
        for c in range(i.shape[1]):
            here = (i[:, c] >= 0) & (s[:, c] > near[:, c]) & (took.sum(axis=1) < most)
            took[:, c] = here
            near[here] = np.maximum(near[here], among[here, c])
        rank = np.where(i < 0, 2, np.where(took, 0, 1))
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        got = np.take_along_axis(i, order, axis=1)
        out[at:at + 512, :got.shape[1]] = got
    return out


@dataclass
class Graph:
    """Nodes in the order of their top layers; ``layers[l]`` links the first nodes, those of layer l."""
    x: np.ndarray  # float32, unit rows
    layers: list[np.ndarray]

    def entry(self, q: np.ndarray, above: int) -> np.ndarray:
        """Where to enter the layer below ``above``: a small beam there, from greedy steps further up."""
        if above >= len(self.layers):
            return np.zeros((len(q), 1), np.int64)
        start = self._greedy(q, above + 1)[:, None]
        return _Search(self.x, self.layers[above], q).beam(start, ENTRIES)[0]

    def _greedy(self, q: np.ndarray, above: int) -> np.ndarray:
        """The nearest nodes that greedy steps reach in layer ``above``, from the top down."""
        at = np.zeros(len(q), np.int64)
        best = _dots(self.x, at, q, np.arange(len(q)))
        for links in self.layers[:above - 1:-1]:
            rows = np.arange(len(q))
            while len(rows):
                near = links[at[rows]]
                sim = np.einsum("ijk,ik->ij", self.x[near], q[rows])
                sim[near < 0] = -np.inf
                c = sim.argmax(axis=1)
                value = sim[np.arange(len(rows)), c]
                up = value > best[rows]
                rows, c = rows[up], c[up]
                at[rows], best[rows] = near[up, c], value[up]
        return at

    def search(self, q: np.ndarray, beam: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of pairs (query, node) at or above ``least`` in single precision."""
        n = len(self.x)
        block = int(min(max(MARKS // (4 * n), 16), 512))
        for at in range(0, len(q), block):
            part = q[at:at + block]
            run = _Search(self.x, self.layers[0], part, least)
            run.beam(self.entry(part, 1), min(beam, n))
            row, node = run.hits()
            yield row + at, node


def _top_k(sims: np.ndarray, k: int) -> np.ndarray:
    k = min(k, sims.shape[1])
    part = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(sims, part, axis=1), axis=1, kind="stable")
    return np.take_along_axis(part, order, axis=1)


def _returned(x: np.ndarray, links: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Links back from the nodes that ``new`` nodes chose."""
    back, node = chosen.ravel().astype(np.int64), new.repeat(chosen.shape[1])
    back, node = back[back >= 0], node[back >= 0]
    sim = _dots(x, back, x, node)
    order = np.lexsort((-sim, back))
    back, node = back[order], node[order]
    who, first, count = np.unique(back, return_index=True, return_counts=True)
    place = np.arange(len(back)) - first.repeat(count)
    wide = min(int(count.max(initial=0)), links.shape[1])
    near = place < wide
    extra = np.full((len(who), wide), -1, np.int64)
    extra[np.arange(len(who)).repeat(count)[near], place[near]] = node[near]
    both = np.concatenate([links[who].astype(np.int64), extra], axis=1)
    used = (both >= 0).sum(axis=1)
    light = used <= links.shape[1]
    order = np.argsort(both[light] < 0, axis=1, kind="stable")[:, :links.shape[1]]
    links[who[light]] = np.take_along_axis(both[light], order, axis=1)
    full = ~light
    if full.any():
        cand = both[full]
        sims = np.einsum("ijk,ik->ij", x[cand], x[who[full]])
        sims[cand < 0] = -np.inf
        order = np.argsort(-sims, axis=1, kind="stable")
        links[who[full]] = _chosen(x, np.take_along_axis(cand, order, axis=1),
                                   np.take_along_axis(sims, order, axis=1), links.shape[1])


def built(x: np.ndarray, level: np.ndarray) -> Graph:
    """The graph of unit rows ``x`` (float32) with falling top layers."""
    graph = Graph(x, [])
    sizes = [int((level >= at).sum()) for at in range(int(level.max(initial=0)) + 1)]
    layers: list[np.ndarray] = []
    for at in range(len(sizes) - 1, -1, -1):
        n, wide = sizes[at], LINKS * (1 if at else 2)
        links = np.full((n, wide), -1, np.int32)
        # the nodes of the layer above (and the first few) are compared with each other whole
        first = min(n, max(256, sizes[at + 1] if at + 1 < len(sizes) else 1))
        graph.layers = [np.zeros((0, 1), np.int32)] * (at + 1) + layers
        done = 0
        while done < n:
            size = first if not done else min(BATCH, done, n - done)
            new = np.arange(done, done + size)
            ids, sims = _candidates(graph, links, new, done, at)
            chosen = _chosen(x, ids, sims, LINKS)
            links[new, :LINKS] = chosen
            _returned(x, links, new, chosen)
            done += size
        _reachable(x, links)
        layers.insert(0, links)
    graph.layers = layers
    return graph


def _candidates(graph: Graph, links: np.ndarray, new: np.ndarray, done: int, at: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (best first) of a batch: a beam among the nodes there, and the batch itself."""
    x, ids, sims = graph.x, [], []
    for s in range(0, len(new), 512):
        part = new[s:s + 512]
        own = x[part] @ x[new].T
        own[np.arange(len(part)), part - new[0]] = -np.inf
        near = _top_k(own, BEAM_BUILD)
        near_sims = np.take_along_axis(own, near, axis=1)
        near = np.where(near_sims > -np.inf, near + new[0], -1)
        if done:
            run = _Search(x, links[:done], x[part])
            there, there_sims = run.beam(graph.entry(x[part], at + 1), BEAM_BUILD)
            near = np.concatenate([there, near], axis=1)
            near_sims = np.concatenate([there_sims, near_sims], axis=1)
            order = np.argsort(-near_sims, axis=1, kind="stable")[:, :BEAM_BUILD]
            near, near_sims = (np.take_along_axis(v, order, axis=1) for v in (near, near_sims))
        ids.append(near)
        sims.append(near_sims)
    return np.concatenate(ids), np.concatenate(sims)


def _reachable(x: np.ndarray, links: np.ndarray) -> None:
    """Nodes that nobody links to take a free or the last place of their own first link."""
    known = np.bincount(links[links >= 0], minlength=len(links))
    for node in np.flatnonzero(known == 0):
        near = links[node]
        near = near[near >= 0]
        if len(near):
            host = near[np.argmax(x[near] @ x[node])]
            free = np.flatnonzero(links[host] < 0)
            links[host, free[0] if len(free) else -1] = node


def audited(graph: Graph, x: np.ndarray, key: np.ndarray, least: float) -> int:
    """The narrowest doubled beam that finds ``RECALL`` of the links of turned sample vectors (0: none)."""
    pick = np.argsort(_mixed(key ^ np.int64(0x5BD1E995)))[:AUDIT]
    # a unit direction at right angles to each, from hashed numbers
    lanes = _mixed(key[pick][:, None] * np.int64(1_000_003) + np.arange(x.shape[1])[None, :])
    side = lanes.astype(np.float64) / 2.0 ** 63 - 1.0
    side -= (side * x[pick]).sum(axis=1, keepdims=True) * x[pick]
    size = np.linalg.norm(side, axis=1, keepdims=True)
    cos = least + 0.02 * (1 - least)
    turned = np.where(size > 1e-9, cos * x[pick] + np.sqrt(1 - cos * cos) * side / np.maximum(size, 1e-9), x[pick])
    truth = int((turned @ x.T >= least).sum())
    beam, q = BEAM, turned.astype(np.float32)
    while truth and beam <= BEAM_MOST:
        got = 0
        for row, node in graph.search(q, beam, least - SLACK):
            got += int((_dots(turned, row, x, node) >= least).sum())
        if got >= RECALL * truth:
            return beam
        beam *= 2
    return 0 if truth else beam


# ------------------------------------------------------------------ shards as tables
def _vectors(table: pa.Table, dim: int) -> np.ndarray:
    return table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _build(least: float, out: T.StructType) -> Callable[[pa.Table], pa.Table]:
    schema = _arrow(out)

    def build(shard: pa.Table) -> pa.Table:
        dim = shard["dim"][0].as_py()
        key = shard["rep"].to_numpy()
        bits = _mixed(key)
        share = (bits.astype(np.float64) + 0.5) / 2.0 ** 64
        level = np.floor(-np.log(share) / np.log(LINKS)).astype(np.int64)
        order = np.lexsort((bits, -level))
        shard, level, key = shard.take(pa.array(order)), level[order], key[order]
        x = unit(_vectors(shard, dim))
        graph = built(x.astype(np.float32), level)
        beam = audited(graph, x, key, least)
        upper = [np.concatenate([links[i] for links in graph.layers[1:int(level[i]) + 1]])
                 for i in range(int((level > 0).sum()))]
        n = len(key)
        return pa.Table.from_arrays(
            [*(shard[c] for c in ("dim", "shard", "rep", "copies", "x")), pa.array(np.arange(n)),
             pa.array(level), _lists(graph.layers[0].ravel(), np.full(n, graph.layers[0].shape[1])),
             _lists(np.concatenate(upper) if upper else np.zeros(0), level * LINKS),
             pa.array(np.full(n, beam), pa.int32())], schema=schema)

    return build


def _loaded(table: pa.Table, x: np.ndarray) -> Graph:
    level = table["level"].to_numpy()
    n = len(level)
    layers = [table["base"].combine_chunks().flatten().to_numpy().reshape(n, -1)]
    flat = table["upper"].combine_chunks().flatten().to_numpy()
    start = np.concatenate([[0], np.cumsum(level * LINKS)])
    for at in range(1, int(level.max(initial=0)) + 1):
        nodes = np.flatnonzero(level >= at)
        layers.append(np.stack([flat[start[i] + (at - 1) * LINKS:start[i] + at * LINKS] for i in nodes]))
    return Graph(x.astype(np.float32), layers)


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest-member labels after joining the ends of the pairs."""
    while True:
        one, two = label[a], label[b]
        open_ = one != two
        if not open_.any():
            return label
        a, b, one, two = a[open_], b[open_], one[open_], two[open_]
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
        while True:
            flat = label[label]
            if (flat == label).all():
                break
            label = flat


OUT = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                    T.StructField("links", T.LongType())])


def _found(graph: Graph, beam: int, q: np.ndarray, x: np.ndarray, least: float
           ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of verified pairs (query, node)."""
    if beam:
        for row, node in graph.search(q.astype(np.float32), beam, least - SLACK):
            real = _dots(q, row, x, node) >= least
            yield row[real], node[real]
    else:
        for at in range(0, len(q), 256):
            row, node = np.nonzero(q[at:at + 256] @ x.T >= least)
            yield row + at, node


def _meet(least: float) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """Links between the vectors of one shard and the graph of another (or its own)."""
    schema = _arrow(OUT)

    def meet(key: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            return schema.empty_table()
        dim = index["dim"][0].as_py()
        index = index.sort_by("node")
        x, q = unit(_vectors(index, dim)), unit(_vectors(queries, dim))
        graph, beam = _loaded(index, x), index["beam"][0].as_py()
        mine, theirs = queries["rep"].to_numpy(), index["rep"].to_numpy()
        m_mine, m_theirs = queries["copies"].to_numpy(), index["copies"].to_numpy()
        same = key[1].as_py() == key[2].as_py()
        if same:  # both sides are the same vectors: pairs of places in the index
            place = np.empty(len(mine), np.int64)
            place[np.argsort(mine)] = np.argsort(theirs)
        n_q, n_x = (0 if same else len(mine)), len(theirs)
        links, label = np.zeros(n_q + n_x, np.int64), np.arange(n_q + n_x)
        copies = m_theirs if same else np.concatenate([m_mine, m_theirs])
        reps = theirs if same else np.concatenate([mine, theirs])
        seen = []
        for row, node in _found(graph, beam, q, x, least):
            if same:
                a, b = place[row], node
                off = a != b
                seen.append(np.unique(np.minimum(a, b)[off] * n_x + np.maximum(a, b)[off]))
                label = _joined(label, a, b)
            else:
                a, b = row, node + n_q
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                label = _joined(label, a, b)
        if same and seen:
            # either direction finds a pair; it counts once for both ends
            pair = np.unique(np.concatenate(seen))
            a, b = pair // n_x, pair % n_x
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
        linked, tree = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(label)))
        return pa.Table.from_arrays(
            [pa.array(np.concatenate([reps[linked], reps[tree]]), pa.int64()),
             pa.array(np.concatenate([np.zeros(len(linked), np.int64), reps[label[tree]]]), pa.int64(),
                      mask=np.arange(len(linked) + len(tree)) < len(linked)),
             pa.array(np.concatenate([links[linked], np.zeros(len(tree), np.int64)]), pa.int64(),
                      mask=np.arange(len(linked) + len(tree)) >= len(linked))], schema=schema)

    return meet


def indexed(distinct: DataFrame, least: float, shards: int = SHARDS) -> tuple[DataFrame, int]:
    """The shards' graphs, a row for each node of ``distinct`` (rep, copies, x, dim), and their number."""
    size = distinct.agg(F.sum(F.col("dim").cast("long") * 8)).first()[0] or 0
    shards = max(shards, -(-size // SHARD_BYTES))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))
    out = T.StructType([*[dealt.schema[c] for c in ("dim", "shard", "rep", "copies", "x")],
                        T.StructField("node", T.LongType()), T.StructField("level", T.LongType()),
                        T.StructField("base", T.ArrayType(T.IntegerType())),
                        T.StructField("upper", T.ArrayType(T.IntegerType())), T.StructField("beam", T.IntegerType())])
    graphs = dealt.repartition(max(shards, 1), "dim", "shard").groupBy("dim", "shard").applyInArrow(
        _build(least, out), out)
    return written(graphs, "small-world"), shards


def links(distinct: DataFrame, least: float, shards: int = SHARDS) -> DataFrame:
    """(a, b, links): a vector's number of links in one pair of shards (b null), or a tree's edge (links null)."""
    graphs, shards = indexed(distinct, least, shards)
    index = graphs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("shard")))).withColumnRenamed("shard", "j")
    queries = graphs.select("dim", F.col("shard").alias("i"), "rep", "copies", "x", F.explode(
        F.sequence(F.col("shard"), F.lit(shards - 1))).alias("j"))
    return (index.groupBy("dim", "i", "j").cogroup(queries.groupBy("dim", "i", "j"))
            .applyInArrow(_meet(least), OUT))


def classes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
            shards: int = SHARDS) -> DataFrame:
    """id, n_links, component_id and kept for every row."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and is at most 1")
    ship_package(df.sparkSession)
    v = of(df, vector_col)
    usable = (v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c)
                                       & (F.abs(c.cast("double")) < float("inf")))
              & F.exists(v, lambda c: c != 0))
    rows = written(df.select(F.monotonically_increasing_id().alias("row"), of(df, id_col).alias("id"),
                             F.when(usable, v).alias("x")), "vectors")
    distinct = written(rows.where("x is not null").groupBy("x").agg(
        F.min("row").alias("rep"), F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dim", F.size("x")), "vectors-distinct")
    found = written(links(distinct.select("rep", "copies", "x", "dim"), threshold, shards), "vector-links")
    counts = found.where("links is not null").groupBy("a").agg(F.sum("links").alias("links"))
    labels = written(components(found.where("b is not null").select("a", "b")).select(
        F.col("id").alias("l_rep"), "label"), "vector-components")
    named = labels.join(distinct.select("rep", "least_id"), labels["l_rep"] == F.col("rep"))
    smallest = named.groupBy("label").agg(F.min("least_id").alias("component"))
    members = labels.join(smallest, "label").select("l_rep", "component")
    per = (distinct.join(counts, distinct["rep"] == counts["a"], "left")
           .join(members, distinct["rep"] == members["l_rep"], "left")
           .select(F.col("x").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                   F.when(F.col("l_rep").isNotNull(), F.col("component")).otherwise(F.col("least_id"))
                   .alias("component")))
    out = rows.join(per, rows["x"] == per["v"], "left")
    component = F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
