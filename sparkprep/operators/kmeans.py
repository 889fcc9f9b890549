"""K-means over many values of K at once, with random or D^2 (k-means++) seeding.

Execution model
* The points are projected to ``(id, x array<double>)``, complete vectors only,
  and persisted (memory and disk) for the iterations; lineage stays one scan.
  Points that lie in fewer tasks than the cluster has cores, as those of a file
  with few row groups do, are dealt out evenly once (``spread``).
* One Spark job per iteration for *all* unfinished models: ``mapInArrow``
  assigns every point of a partition to its nearest centroid under the current
  centroids C(t-1) and the previous ones C(t-2) (so the reassigned fraction
  needs no stored assignment column) and emits per-(model, cluster) partial
  counts and coordinate sums. Coordinates are added as whole numbers on a grid
  (``operators/reduction.py``) and combined in a tree over the tasks, so every
  centroid has the same bits for any partitioning, and no row or task holds
  more than ``FAN`` partial results of a cluster however many tasks there are.
* Centroids travel with the task closure, at most ``BLOCK_BYTES`` at a time.
  Models beyond that go block after block: each pass compares the points with
  one block and keeps their nearest centroids so far in the checkpointed points.
* A final pass yields the objective and the simplified silhouette together.
* Random seeding takes the K points with the smallest hash-uniform of the id
  (a top-K, no sort of the data). D^2 seeding picks, in round r, the point
  minimising ``-ln(u(id, seed, r)) / D^2`` (an exponential race, Efraimidis &
  Spirakis 2006, equal in law to sampling proportional to D^2); each task
  returns its best few candidates, a tournament between tasks keeps the best
  of all, and several rounds are decided by one job. Seeds for K are the first
  K picks, so a sweep costs max(K) rounds in total. Ids may be of any type that
  Spark orders.
* Each model stands for itself: a K that the points cannot seed has a row whose
  ``status`` says why, and the others run.

Definitions (the reference's library is absent): ``frac_reassigned`` is the
share of points whose nearest centroid changed between the last two
assignments (1.0 on the first); iteration stops when it is at most
``min_frac_reassigned`` or after ``max_iter``; an empty cluster keeps its
centroid; ties go to the lower centroid index; ``objective_fn`` is the sum of
the points' distances to the final centroids; silhouette is
``avg((d2 - d1) / d2)`` (0 when d2 = 0) and NULL for K = 1. The distance metric
is ``squared_dist_norm2`` or its root ``dist_norm2`` (same assignments), the
centroid aggregate ``avg``; any other name is an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.constants import (ALGO_KMEANSPP, ALGO_RANDOM, KMEANS_MAX_ITER,
                                 KMEANS_MIN_FRAC_REASSIGNED)
from sparkprep.functions.arrays import METRICS, metric_name
from sparkprep.functions.hashing import hash_uniform
from sparkprep.operators import reduction
from sparkprep.operators.schema import qcol
from sparkprep.session import checkpoint_dir, ship_package

ALGOS = {"random": ALGO_RANDOM, ALGO_RANDOM: ALGO_RANDOM,
         "kmeanspp": ALGO_KMEANSPP, ALGO_KMEANSPP: ALGO_KMEANSPP}
AGGREGATES = ("avg",)
# Centroids that travel with one pass's task closure (bytes); larger models take several passes.
BLOCK_BYTES = 64 * 1024 * 1024
# Partial sums a task holds for one model before it emits them batch by batch (values).
HELD_VALUES = 16_000_000
# Clusters of a batch up to which their sums are one matrix product.
MATRIX_CLUSTERS = 8
CHUNK_VALUES = 8_000_000  # doubles per distance chunk (64 MB)
# Models up to this many centroids are compared centroid by centroid, for so many rows at once
# that the scores stay in the processor's cache.
LOOP_CLUSTERS, LOOP_ROWS = 64, 4096
# Coordinates that make a task of their own worth while, and tasks for each core.
TASK_VALUES, CORE_TASKS = 100_000, 2

RESULT_SCHEMA = T.StructType([
    T.StructField("num_clusters", T.IntegerType()),
    T.StructField("centroids", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("objective_fn", T.DoubleType()),
    T.StructField("frac_reassigned", T.DoubleType()),
    T.StructField("num_iterations", T.IntegerType()),
    T.StructField("simple_silhouette", T.DoubleType()),
    T.StructField("status", T.StringType()),
])


def aggregate_name(name: str) -> str:
    """The centroid aggregate, with or without a schema prefix; unknown ones raise."""
    plain = name.rsplit(".", 1)[-1]
    if plain not in AGGREGATES:
        raise ValueError(f"unknown centroid aggregate {name!r}; known: {', '.join(AGGREGATES)}")
    return plain


def prepare_points(df: DataFrame, id_col: str, features_col: str) -> DataFrame:
    """``(id, x)`` with ``x`` a complete ``array<double>`` (NULL vectors and
    vectors holding a NULL are skipped)."""
    x = F.col(qcol(features_col)).cast("array<double>")
    return (df.select(F.col(qcol(id_col)).alias("id"), x.alias("x"))
            .filter(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull())))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    col = batch.column("x")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    vals = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if len(vals) != len(batch) * d:
        raise ValueError(f"feature vectors must all have {d} elements")
    return vals.reshape(-1, d) if d else np.zeros((len(batch), 0))


def _sqdist(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, rows of ``x`` against rows of ``c`` (k, d) or
    each row's own (n, k, d), from exact differences; rows are taken in chunks of
    about ``CHUNK_VALUES`` differences so memory stays bounded."""
    own = c.ndim == 3
    k = c.shape[-2]
    out = np.empty((x.shape[0], k))
    step = max(1, CHUNK_VALUES // max(1, k * c.shape[-1]))
    for s in range(0, x.shape[0], step):
        diff = x[s:s + step, None, :] - (c[s:s + step] if own else c[None, :, :])
        out[s:s + step] = np.einsum("ijk,ijk->ij", diff, diff)
    return out


def _scores(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``||c||^2 - 2 x.c``: the row constant ``||x||^2`` does not change the order."""
    score = x @ c.T
    score *= -2.0
    score += np.einsum("ij,ij->i", c, c)[None, :]
    return score


def _nearest(x: np.ndarray, c: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and exact squared distances (n, m) of the ``m`` nearest centroids,
    ascending, ties to the lower index (-1 and inf beyond the last centroid).

    A matrix product ranks the centroids; exact differences decide among the best
    few, or among all for rows where rounding could hide another candidate.
    """
    n, k = len(x), len(c)
    idx = np.full((n, m), -1, np.int64)
    dist = np.full((n, m), np.inf)
    spare = m + 4
    if k <= spare:
        near = np.tile(np.arange(k), (n, 1))
        exact = _sqdist(x, c)
    else:
        score = _scores(x, c)
        part = np.argpartition(score, spare, axis=1)[:, :spare + 1]
        ranked = np.sort(np.take_along_axis(score, part, axis=1), axis=1)
        scale = np.einsum("ij,ij->i", x, x) + np.einsum("ij,ij->i", c, c).max() + 1.0
        near = np.sort(part, axis=1)
        exact = _sqdist(x, c[near])
        close = np.flatnonzero(ranked[:, spare] - ranked[:, m - 1] <= 1e-9 * scale)
        if len(close):
            full = _sqdist(x[close], c)
            top = np.argsort(full, axis=1, kind="stable")[:, :spare + 1]
            near[close], exact[close] = top, np.take_along_axis(full, top, axis=1)
    order = np.argsort(exact, axis=1, kind="stable")[:, :m]
    idx[:, :order.shape[1]] = np.take_along_axis(near, order, axis=1)
    dist[:, :order.shape[1]] = np.take_along_axis(exact, order, axis=1)
    return idx, dist


def _two_best(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index and score (``_scores``) of the best centroid, and the score of the second."""
    n, k = len(x), len(c)
    if k > LOOP_CLUSTERS:
        score = _scores(x, c)
        a = score.argmin(axis=1)
        rows = np.arange(n)
        best = score[rows, a].copy()
        score[rows, a] = np.inf
        return a, best, score.min(axis=1)
    a, best, second = np.zeros(n, np.int64), np.empty(n), np.full(n, np.inf)
    doubled, own = -2.0 * c, np.einsum("ij,ij->i", c, c)[:, None]
    for s in range(0, n, LOOP_ROWS):
        score = doubled @ x[s:s + LOOP_ROWS].T
        score += own
        first, runner = score[0].copy(), second[s:s + LOOP_ROWS]
        for row in score[1:]:
            np.minimum(runner, np.maximum(first, row), out=runner)
            np.minimum(first, row, out=first)
        index = np.zeros(len(first), np.int16)
        for j in range(k - 1, 0, -1):
            np.copyto(index, j, where=score[j] == first)
        np.copyto(index, 0, where=score[0] == first)
        a[s:s + LOOP_ROWS], best[s:s + LOOP_ROWS] = index, first
    return a, best, second


def _assign(x: np.ndarray, c: np.ndarray, with_margin: bool = False):
    """Index of the nearest centroid (ties to the lower index).

    Rows whose two best candidates are within rounding of each other are decided
    again with exact differences, so the answer equals the exact argmin. With
    ``with_margin`` also returns a lower bound on (second-nearest - nearest)
    distance per row, net of rounding.
    """
    n, k = len(x), len(c)
    if k == 1:
        a = np.zeros(n, dtype=np.int64)
        return (a, np.full(n, np.inf)) if with_margin else a
    a, best, second = _two_best(x, c)
    gap = second - best
    xx = np.einsum("ij,ij->i", x, x)
    scale = xx + np.einsum("ij,ij->i", c, c).max() + 1.0
    close = np.nonzero(gap <= 1e-9 * scale)[0]
    if len(close):
        a[close] = _sqdist(x[close], c).argmin(axis=1)
    if not with_margin:
        return a
    margin = (np.sqrt(np.maximum(second + xx, 0.0)) - np.sqrt(np.maximum(best + xx, 0.0))
              - 1e-6 * np.sqrt(scale))
    margin[close] = -np.inf
    return a, margin


@dataclass
class Shape:
    """What the passes know of the points: their number, length, tasks, and the grid's exponents."""
    n: int
    d: int
    parts: int
    exp: np.ndarray

    @property
    def sums(self) -> int:
        return self.d * reduction.PARTS

    @property
    def exp_total(self) -> np.ndarray:
        """Exponents for a squared distance between two points, and for a silhouette."""
        top = int(self.exp.max(initial=0))
        return np.array([2 * top + 2 + int(np.ceil(np.log2(max(self.d, 1)))), 1])


def shape_of(points: DataFrame) -> Shape:
    """Length (checked to be the same on every row), number, tasks and largest
    coordinates. On persisted points the first aggregate also materialises the cache."""
    sizes = points.select(F.size("x").alias("d"), F.spark_partition_id().alias("pid"))
    row = sizes.agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"),
                    (F.max("pid") + 1).alias("parts")).first()
    if not row["n"]:
        raise ValueError("no complete feature vectors")
    if row["lo"] != row["hi"]:
        raise ValueError(f"feature vectors must all have the same length ({row['lo']} to {row['hi']})")
    d = int(row["hi"])
    schema = pa.schema([("pid", pa.int32()), ("v", pa.list_(pa.float64()))])

    def largest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        top = np.zeros(d)
        for b in batches:
            if b.num_rows:
                top = np.maximum(top, np.abs(_matrix(b, d)).max(axis=0, initial=0.0))
        yield pa.RecordBatch.from_pylist([{"pid": TaskContext.get().partitionId(), "v": top.tolist()}],
                                         schema=schema)

    rows = reduction.tree(points.select("x").mapInArrow(largest, "pid int, v array<double>"), [],
                          int(row["parts"]), [], ["v"], largest=True,
                          driver_rows=reduction.driver_rows(d))
    top = rows[0]["v"]
    if not np.isfinite(top).all():
        raise ValueError("feature vectors must hold finite numbers")
    return Shape(int(row["n"]), d, int(row["parts"]), reduction.exponents(top))


def spread(points: DataFrame, shape: Shape) -> DataFrame:
    """``points`` in a few even tasks for each core (``shape.parts`` follows), persisted, if
    they lie in fewer and there is enough to do; else as they are."""
    wanted = min(CORE_TASKS * points.sparkSession.sparkContext.defaultParallelism,
                 -(-shape.n * max(shape.d, 1) // TASK_VALUES))
    if shape.parts >= wanted:
        return points
    shape.parts = wanted
    return points.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)


# ---------------------------------------------------------------- blocks of centroids
@dataclass
class _Part:
    """Centroids ``first ..`` of model ``m``, as far as they go with one pass."""
    m: int
    first: int
    c: np.ndarray


def _blocks(models: Iterable[tuple[int, np.ndarray]]) -> Iterator[list[_Part]]:
    """Consecutive centroids of the models in blocks of at most ``BLOCK_BYTES``."""
    block: list[_Part] = []
    used = 0
    for m, c in models:
        width = max(1, c.shape[1] * 8)
        at = 0
        while at < len(c):
            fit = max((BLOCK_BYTES - used) // width, 0 if block else 1)
            if not fit:
                yield block
                block, used = [], 0
                continue
            block.append(_Part(m, at, c[at:at + fit]))
            used += len(block[-1].c) * width
            at += fit
    if block:
        yield block


def _is_one(models: list[tuple[int, np.ndarray]]) -> bool:
    return sum(c.size for _, c in models) * 8 <= BLOCK_BYTES


def nearest(points: DataFrame, blocks: Iterable[list[_Part]], n_models: int, m: int, d: int) -> DataFrame:
    """``points`` plus ``near array<int>`` and ``dist array<double>``: for each model the
    ``m`` nearest centroids and squared distances, block after block.

    Each block is one pass; with more than one the points and their best so far lie
    in the checkpoint folder in between.
    """
    spark = points.sparkSession
    out = T.StructType([*points.schema.fields, T.StructField("near", T.ArrayType(T.IntegerType())),
                        T.StructField("dist", T.ArrayType(T.DoubleType()))])
    wide = n_models * m
    kept = [f.name for f in points.schema.fields]
    first = True

    def step(block: list[_Part], fresh: bool):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n = b.num_rows
                if not n:
                    continue
                x = _matrix(b, d)
                if fresh:
                    near, dist = np.full((n, n_models, m), -1, np.int64), np.full((n, n_models, m), np.inf)
                else:
                    near = b.column("near").flatten().to_numpy().reshape(n, n_models, m).astype(np.int64)
                    dist = b.column("dist").flatten().to_numpy().reshape(n, n_models, m).copy()
                for part in block:
                    idx, sq = _nearest(x, part.c, m)
                    idx = np.where(idx >= 0, idx + part.first, -1)
                    # earlier centroids stand first, so a stable sort keeps ties at the lower index
                    both_d = np.concatenate([dist[:, part.m], sq], axis=1)
                    both_i = np.concatenate([near[:, part.m], idx], axis=1)
                    order = np.argsort(both_d, axis=1, kind="stable")[:, :m]
                    near[:, part.m] = np.take_along_axis(both_i, order, axis=1)
                    dist[:, part.m] = np.take_along_axis(both_d, order, axis=1)
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * wide)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in kept),
                     pa.ListArray.from_arrays(offsets, pa.array(near.ravel().astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(dist.ravel()))], names=out.names)
        return run

    state = points
    for block in blocks:
        if not first:
            checkpoint_dir(spark)
            state = state.checkpoint(eager=True)
        state = state.mapInArrow(step(block, first), out)
        first = False
    if first:
        state = points.withColumn("near", F.array().cast("array<int>")).withColumn(
            "dist", F.array().cast("array<double>"))
    return state


# ---------------------------------------------------------------- seeding
def seed_random(points: DataFrame, k: int, seed: int = 42) -> np.ndarray:
    """The ``k`` points with the smallest hash-uniform of the id (ties by id)."""
    rows = (points.select("id", "x", hash_uniform("id", seed=seed).alias("u"))
            .orderBy("u", "id").limit(k).collect())
    return np.array([r["x"] for r in rows], dtype=np.float64)


def seed_kmeanspp(points: DataFrame, k: int, seed: int = 42,
                  rounds_per_job: int = 8, candidates: int = 32, shape: Shape | None = None) -> np.ndarray:
    """D^2 seeding by exponential races, several rounds per job.

    Round r picks the point minimising ``-ln(u(id, seed, r)) / D^2`` (ties by
    id). Every u is known in advance and D^2 only shrinks as centroids are
    added, so ``-ln(u_r) / D^2_now`` bounds a point's key in any later round
    from below. One job finds the ``candidates`` best points by that bound for
    each of the next ``rounds_per_job`` rounds, plus the smallest bound left
    out; the driver replays the rounds and accepts a pick only while it beats
    every bound left out, else the next job resumes there. The picks equal the
    one-round-per-job race exactly. The driver receives at most ``candidates``
    points per round from each of ``FAN`` tasks, whatever the number of tasks:
    a tournament between them goes before.
    """
    ship_package(points.sparkSession)
    shape = shape or shape_of(points)
    d = shape.d
    chosen = np.zeros((0, d))
    if k < 1:
        return chosen
    first = (points.select("id", "x", hash_uniform("id", F.lit(1), seed=seed).alias("u"))
             .orderBy(F.desc("u"), "id").limit(1).collect())  # the smallest -ln(u)
    if not first:
        return chosen
    chosen = np.array([first[0]["x"]], dtype=np.float64)
    rows = points.withColumn("far", F.lit(float("inf")))
    folded = 0  # centroids whose distances the points already carry
    while len(chosen) < k:
        if (len(chosen) - folded) * d * 8 > BLOCK_BYTES:
            checkpoint_dir(points.sparkSession)
            rows = _carried(rows, chosen[folded:], d).checkpoint(eager=True)
            folded = len(chosen)
        r = len(chosen) + 1
        rounds = list(range(r, min(k, r + rounds_per_job - 1) + 1))
        picks = _race_rounds(rows, chosen[folded:], shape, rounds, seed, candidates)
        if not picks:
            break
        chosen = np.vstack([chosen] + [np.asarray(p, dtype=np.float64)[None, :] for p in picks])
    return chosen[:k]


def _shrunk(b: pa.RecordBatch, x: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    far = b.column("far").to_numpy(zero_copy_only=False)
    return np.minimum(far, _nearest(x, fresh, 1)[1][:, 0]) if len(fresh) else far


def _carried(rows: DataFrame, fresh: np.ndarray, d: int) -> DataFrame:
    """``rows`` with ``far`` lowered to the squared distance to the nearest of ``fresh``."""
    def lower(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                far = pa.array(_shrunk(b, _matrix(b, d), fresh))
                yield b.set_column(b.schema.get_field_index("far"), "far", far)
    return rows.mapInArrow(lower, rows.schema)


def _race_rounds(rows: DataFrame, fresh: np.ndarray, shape: Shape, rounds: list[int],
                 seed: int, m: int) -> list:
    """Certified winners of consecutive ``rounds`` (at least the first, unless no
    point is left at positive distance)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    n_r, d = len(rounds), shape.d
    u = F.array(*[hash_uniform("id", F.lit(q), seed=seed) for q in rounds]).alias("u")
    one = T.StructType([T.StructField("lb", T.DoubleType()), T.StructField("id", rows.schema["id"].dataType),
                        T.StructField("d2", T.DoubleType()), T.StructField("e", T.DoubleType()),
                        T.StructField("x", T.ArrayType(T.DoubleType()))])
    schema = T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("t", T.IntegerType()),
                           T.StructField("rest", T.DoubleType()), *one.fields])
    arrow = to_arrow_schema(schema)
    plain = isinstance(rows.schema["id"].dataType, T.AtomicType)

    def best_of(cand: pa.Table) -> tuple[pa.Table, float]:
        """The m best by (bound, id), and the smallest bound left out."""
        lb = cand["lb"].to_numpy()
        if len(lb) <= m:
            return cand, np.inf
        cut = np.partition(lb, m - 1)[m - 1]
        pool = cand.filter(pa.array(lb <= cut))
        if pool.num_rows > m:  # ties at the limit: the smaller id
            keys = [("lb", "ascending"), *([("id", "ascending")] if plain else [])]
            pool = pool.take(pc.sort_indices(pool, sort_keys=keys)[:m])
        above = lb[lb > cut]
        return pool, float(cut if (lb <= cut).sum() > m else above.min() if len(above) else np.inf)

    def race(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        keep: list = [None] * n_r
        rest = np.full(n_r, np.inf)  # smallest bound not kept
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b, d)
            uu = b.column("u").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_r)
            d2 = _shrunk(b, x, fresh)
            e = -np.log(uu)
            with np.errstate(divide="ignore"):
                bounds = np.where(d2[:, None] > 0, e / np.where(d2 > 0, d2, 1.0)[:, None], np.inf)
            for t in range(n_r):
                lb = bounds[:, t]
                at = np.flatnonzero(np.isfinite(lb))
                if len(at) > 4 * m:
                    cut = np.partition(lb, m)[m]
                    out = lb[at] > cut
                    if out.any():
                        rest[t] = min(rest[t], float(lb[at][out].min()))
                    at = at[~out]
                if not len(at):
                    continue
                take = pa.array(at)
                cand = pa.table({"lb": pa.array(lb[at]), "id": b.column("id").take(take), "d2": pa.array(d2[at]),
                                 "e": pa.array(e[at, t]), "x": b.column("x").take(take)})
                if keep[t] is not None:
                    cand = pa.concat_tables([keep[t], cand.cast(keep[t].schema)])
                keep[t], left = best_of(cand)
                rest[t] = min(rest[t], left)
        for t in range(n_r):
            held = keep[t]
            size = held.num_rows if held is not None else 0
            tags = [pa.array([pid] * (size + 1), pa.int32()), pa.array([t] * (size + 1), pa.int32()),
                    pa.array([None] * size + [float(rest[t])], pa.float64())]
            # the candidates, then one row without any for the bound
            own = [pa.concat_arrays([*(c.cast(arrow.field(f).type) for c in (held[f].chunks if size else ())),
                                     pa.nulls(1, arrow.field(f).type)]) for f in one.names]
            yield pa.RecordBatch.from_arrays(tags + own, schema=arrow)

    got = rows.select("id", "x", "far", u).mapInArrow(race, schema)
    parts = shape.parts
    while parts > reduction.driver_rows(n_r * m * (d + 5)):
        unit = F.floor(F.col("pid") / F.lit(reduction.FAN)).cast("int").alias("pid")
        some = F.when(F.col("lb").isNotNull(), F.struct(*one.names))
        met = got.groupBy("t", unit).agg(F.sort_array(F.collect_list(some)).alias("c"), F.min("rest").alias("rest"))
        left = F.coalesce(F.get("c", F.lit(m))["lb"], F.lit(float("inf")))
        met = met.select("pid", "t", F.least("rest", left).alias("rest"), F.slice("c", 1, m).alias("c"))
        # a bound row without candidate, and a row for each candidate
        tail = F.array(F.struct("rest", F.lit(None).cast(one).alias("c")))
        each = F.concat(F.transform("c", lambda s: F.struct(F.lit(None).cast("double").alias("rest"), s.alias("c"))), tail)
        got = met.select("pid", "t", F.explode(each).alias("r")).select(
            "pid", "t", F.col("r.rest").alias("rest"), *[F.col("r.c")[f].alias(f) for f in one.names])
        parts = -(-parts // reduction.FAN)
    cands: dict = {t: [] for t in range(n_r)}
    bound = np.full(n_r, np.inf)
    for row in got.collect():
        if row["lb"] is None:
            bound[row["t"]] = min(bound[row["t"]], row["rest"])
        else:
            cands[row["t"]].append(row)
    picks: list = []
    for t in range(n_r):
        best = None
        for c in cands[t]:
            x = np.asarray(c["x"], dtype=np.float64)
            dd = c["d2"]
            for w in picks:
                dd = min(dd, float(((x - w) ** 2).sum()))
            key = c["e"] / dd if dd > 0 else np.inf
            # ties go to the smaller id, a null one first
            if np.isfinite(key) and (best is None or key < best[0] or key == best[0] and (
                    c["id"] is None or best[1] is not None and c["id"] < best[1])):
                best = (key, c["id"], x)
        if best is None:
            break
        if t > 0 and not best[0] < bound[t]:
            break  # a point left out might still win: resume from this round
        picks.append(best[2])
    return picks


# ---------------------------------------------------------------- Lloyd
@dataclass
class _Model:
    k: int
    c: np.ndarray
    prev: np.ndarray | None = None
    iters: int = 0
    frac: float = 1.0
    done: bool = False


PARTIAL = T.StructType([T.StructField("m", T.IntegerType()), T.StructField("c", T.IntegerType()),
                        T.StructField("pid", T.IntegerType()), T.StructField("cnt", T.LongType()),
                        T.StructField("chg", T.LongType()), T.StructField("s", T.ArrayType(T.LongType()))])
_PARTIAL = pa.schema([("m", pa.int32()), ("c", pa.int32()), ("pid", pa.int32()), ("cnt", pa.int64()),
                      ("chg", pa.int64()), ("s", pa.list_(pa.int64()))])


def _partial_rows(m: int, pid: int, which: np.ndarray, cnt: np.ndarray, chg: np.ndarray,
                  sums: np.ndarray) -> pa.RecordBatch:
    n, w = sums.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * w),
                                     pa.array(sums.ravel().astype(np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, m, np.int32)), pa.array(which.astype(np.int32)), pa.array(np.full(n, pid, np.int32)),
         pa.array(cnt.astype(np.int64)), pa.array(chg.astype(np.int64)), lists], schema=_PARTIAL)


class _Sums:
    """A task's counts and coordinate sums of one model's clusters."""

    def __init__(self, m: int, k: int, w: int, pid: int):
        self.m, self.w, self.pid = m, w, pid
        self.held = (np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, w), np.int64)
                     ) if k * w <= HELD_VALUES else None

    def add(self, a: np.ndarray, moved: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
        # numbered anew only where most clusters have no point of the batch
        which, inv = (np.unique(a, return_inverse=True) if self.held is None or len(self.held[0]) > len(a)
                      else (np.arange(len(self.held[0])), a))
        n = len(which)
        # whole numbers below 2**53, so the order of adding is free
        if n <= MATRIX_CLUSTERS:
            sums = ((inv == np.arange(n)[:, None]).astype(np.float64) @ parts).astype(np.int64)
        else:
            sums = np.empty((n, self.w), np.int64)
            for i, part in enumerate(parts.T):
                sums[:, i] = np.bincount(inv, weights=part, minlength=n)
        cnt, chg = np.bincount(inv, minlength=n), np.bincount(inv[moved], minlength=n)
        if self.held is None:  # too many clusters to hold: this batch's go on at once
            yield _partial_rows(self.m, self.pid, which, cnt, chg, sums)
            return
        self.held[0][which] += cnt
        self.held[1][which] += chg
        self.held[2][which] += sums

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held is not None:
            which = np.flatnonzero(self.held[0])
            if len(which):
                yield _partial_rows(self.m, self.pid, which, *(v[which] for v in self.held))


def _moves(c: np.ndarray, prev: np.ndarray) -> np.ndarray:
    """Each centroid's move plus the largest move of the others."""
    move = np.sqrt(((c - prev) ** 2).sum(axis=1))
    if len(move) == 1:
        return move
    second, top = np.partition(move, len(move) - 2)[-2:]
    others = np.full(len(move), top)
    others[move.argmax()] = second
    return move + others


def _iteration(points: DataFrame, models: list[_Model], shape: Shape) -> dict:
    """One Lloyd pass for every unfinished model: ``{model: [cluster rows]}``."""
    from pyspark import TaskContext
    d, w, exp = shape.d, shape.sums, shape.exp
    active = [(i, m.c, m.prev) for i, m in enumerate(models) if not m.done]
    k_total = sum(len(c) for _, c, _ in active)
    both = [(i, c) for i, c, _ in active] + [(i, p) for i, _, p in active if p is not None]
    if _is_one(both):
        # per model and centroid, by how much a lead may have shrunk since the previous assignment
        moves = {i: _moves(c, prev) if prev is not None else None for i, c, prev in active}

        def partial_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pid = TaskContext.get().partitionId()
            acc = {i: _Sums(i, len(c), w, pid) for i, c, _ in active}
            for b in batches:
                if b.num_rows == 0:
                    continue
                x = _matrix(b, d)
                # one row for each part, so that a part's values lie together
                parts = np.ascontiguousarray(reduction.split(x, exp).T).T
                for i, c, prev in active:
                    a, margin = _assign(x, c, with_margin=True)
                    moved = np.zeros(len(a), dtype=bool)
                    if prev is not None:
                        # Triangle inequality: a point whose nearest centroid leads the
                        # runner-up by more than its own move and the largest of the others
                        # had the same nearest centroid before; only the rest are recomputed.
                        doubt = np.nonzero(~(margin > moves[i][a]))[0]
                        if len(doubt):
                            moved[doubt] = a[doubt] != _assign(x[doubt], prev)
                    yield from acc[i].add(a, moved, parts)
            for held in acc.values():
                yield from held.rest()

        partials = points.select("x").mapInArrow(partial_sums, PARTIAL)
    else:
        # one model place for each current and each previous set of centroids
        place = list(enumerate([c for _, c in both]))
        back = {i: at for at, (i, _) in enumerate(both) if at >= len(active)}
        seen = nearest(points.select("x"), _blocks(place), len(place), 1, d)

        def blocked_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pid = TaskContext.get().partitionId()
            acc = [_Sums(i, len(c), w, pid) for i, c, _ in active]
            for b in batches:
                if b.num_rows == 0:
                    continue
                x = _matrix(b, d)
                parts = reduction.split(x, exp)
                near = b.column("near").flatten().to_numpy().reshape(len(x), -1)
                for at, (i, _, _) in enumerate(active):
                    moved = near[:, at] != near[:, back[i]] if i in back else np.zeros(len(x), bool)
                    yield from acc[at].add(near[:, at], moved, parts)
            for held in acc:
                yield from held.rest()

        partials = seen.mapInArrow(blocked_sums, PARTIAL)
    out: dict = {}
    for r in reduction.tree(partials, ["m", "c"], shape.parts, ["cnt", "chg"], ["s"],
                            driver_rows=reduction.driver_rows(k_total * (w + 4))):
        out.setdefault(r["m"], []).append({**r, "s": reduction.value(r["s"], exp)})
    return out


def _final_pass(points: DataFrame, models: list[_Model], shape: Shape, metric: str = "squared_dist_norm2") -> dict:
    """Objective and silhouette sums of every model: ``{model: {n, sse, sil}}``."""
    return _scored(points, _blocks((i, m.c) for i, m in enumerate(models)), len(models), shape, metric)


def _scored(points: DataFrame, blocks: Iterable[list[_Part]], n_models: int, shape: Shape, metric: str) -> dict:
    from pyspark import TaskContext
    far, exp = METRICS[metric], shape.exp_total
    seen = nearest(points.select("x"), blocks, n_models, 2, shape.d)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        cnt, sums = 0, np.zeros((n_models, 2 * reduction.PARTS), np.int64)
        for b in batches:
            if b.num_rows == 0:
                continue
            dist = b.column("dist").flatten().to_numpy().reshape(b.num_rows, n_models, 2)
            d1, d2 = far(dist[..., 0]), far(dist[..., 1])
            with np.errstate(invalid="ignore", divide="ignore"):
                sil = np.where(np.isinf(d2) | (d2 == 0), 0.0, (d2 - d1) / np.where(d2 == 0, 1.0, d2))
            cnt += b.num_rows
            pair = np.stack([np.where(np.isinf(d1), 0.0, d1), sil], axis=2)
            sums += reduction.split(pair, exp).sum(axis=0).astype(np.int64)
        if cnt:
            n = np.full(n_models, cnt)
            yield from (pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([0], pa.int32()), pa.array([pid], pa.int32()),
                 pa.array([int(n[i])], pa.int64()), pa.array([0], pa.int64()),
                 pa.array([sums[i].tolist()], pa.list_(pa.int64()))], schema=_PARTIAL) for i in range(n_models))

    rows = reduction.tree(seen.mapInArrow(score, PARTIAL), ["m"], shape.parts, ["cnt"], ["s"],
                          driver_rows=reduction.driver_rows(n_models * 12))
    got = {r["m"]: (r["cnt"], reduction.value(r["s"], exp)) for r in rows}
    return {m: {"n": n, "sse": float(v[0]), "sil": float(v[1])} for m, (n, v) in got.items()}


def _lloyd(points: DataFrame, models: list[_Model], shape: Shape, max_iter: int,
           min_frac_reassigned: float) -> None:
    while not all(m.done for m in models):
        parts = _iteration(points, models, shape)
        for i, m in enumerate(models):
            if m.done:
                continue
            rows = parts.get(i, [])
            n = sum(r["cnt"] for r in rows)
            new = m.c.copy()
            for r in rows:
                new[r["c"]] = r["s"] / r["cnt"]
            m.iters += 1
            m.frac = 1.0 if m.prev is None else (sum(r["chg"] for r in rows) / n if n else 0.0)
            m.prev, m.c = m.c, new
            if m.frac <= min_frac_reassigned or m.iters >= max_iter:
                m.done = True


def kmeans_sweeps(df: DataFrame, id_col: str, features_col: str, ks,
                  inits=("random", "kmeanspp"), max_iter: int = KMEANS_MAX_ITER,
                  min_frac_reassigned: float = KMEANS_MIN_FRAC_REASSIGNED,
                  seed: int = 42, metric: str = "squared_dist_norm2", aggregate: str = "avg") -> DataFrame:
    """Sweeps under several seedings whose models all iterate together (one job
    per iteration for every (seeding, K)). Rows: ``algo_type`` plus the
    columns of ``kmeans_sweep``."""
    ks = [int(k) for k in ks]
    if not ks or min(ks) < 1:
        raise ValueError("every K must be at least 1")
    for init in inits:
        if init not in ALGOS:
            raise ValueError(f"unknown initialisation {init!r}")
    metric, aggregate = metric_name(metric), aggregate_name(aggregate)
    spark = df.sparkSession
    ship_package(spark)
    given = points = prepare_points(df, id_col, features_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shape = shape_of(points)
        points = spread(given, shape)
        models: list[_Model] = []
        plan: list[tuple] = []  # (algorithm, K, model or None, reason)
        for init in inits:
            algo = ALGOS[init]
            most = max([k for k in ks if k <= shape.n], default=0)
            seeds = np.zeros((0, shape.d))
            if most:
                seeds = (seed_kmeanspp(points, most, seed, shape=shape) if algo == ALGO_KMEANSPP
                         else seed_random(points, most, seed))
            for k in ks:
                if k > shape.n:
                    plan.append((algo, k, None, f"K = {k} exceeds the {shape.n} points with complete vectors"))
                elif k > len(seeds):
                    plan.append((algo, k, None, f"only {len(seeds)} distinct points to seed K = {k}"))
                else:
                    models.append(_Model(k=k, c=seeds[:k].copy()))
                    plan.append((algo, k, len(models) - 1, None))
        _lloyd(points, models, shape, max_iter, min_frac_reassigned)
        scores = _final_pass(points, models, shape, metric) if models else {}
    finally:
        points.unpersist()
        given.unpersist()
    rows = []
    for algo, k, i, reason in plan:
        if i is None:
            rows.append((algo, k, None, None, None, None, None, reason))
            continue
        m, s = models[i], scores[i]
        sil = s["sil"] / s["n"] if len(m.c) >= 2 else None
        rows.append((algo, m.k, m.c.tolist(), s["sse"], float(m.frac), int(m.iters), sil, None))
    schema = T.StructType([T.StructField("algo_type", T.StringType())] + RESULT_SCHEMA.fields)
    return spark.createDataFrame(rows, schema)


def kmeans_sweep(df: DataFrame, id_col: str, features_col: str, ks, init: str = "random",
                 max_iter: int = KMEANS_MAX_ITER,
                 min_frac_reassigned: float = KMEANS_MIN_FRAC_REASSIGNED,
                 seed: int = 42, metric: str = "squared_dist_norm2", aggregate: str = "avg") -> DataFrame:
    """One row per K: ``num_clusters, centroids, objective_fn, frac_reassigned,
    num_iterations, simple_silhouette, status``. All K iterate together; a K that
    cannot be seeded has nulls and the reason in ``status``."""
    out = kmeans_sweeps(df, id_col, features_col, ks, (init,), max_iter,
                        min_frac_reassigned, seed, metric, aggregate)
    return out.drop("algo_type")


def kmeans(df: DataFrame, id_col: str, features_col: str, k: int, init: str = "random",
           max_iter: int = KMEANS_MAX_ITER,
           min_frac_reassigned: float = KMEANS_MIN_FRAC_REASSIGNED, seed: int = 42,
           metric: str = "squared_dist_norm2", aggregate: str = "avg") -> DataFrame:
    """A single K (``kmeans_random`` / ``kmeanspp`` of the reference)."""
    return kmeans_sweep(df, id_col, features_col, [k], init, max_iter, min_frac_reassigned, seed,
                        metric, aggregate)


def kmeans_compare(random_df: DataFrame, kmeanspp_df: DataFrame | None = None,
                   best: bool = False) -> DataFrame:
    """Union of two sweeps labelled by ``algo_type`` (or one ``kmeans_sweeps``
    result that already carries it), centroids dropped, ordered by silhouette
    descending with NULLs first (the reference's database order), models that
    could not be seeded last; ``best`` keeps the top row."""
    cols = ["num_clusters", "objective_fn", "frac_reassigned", "num_iterations", "simple_silhouette"]

    def failed(df: DataFrame):
        return (F.col("num_iterations").isNull()).alias("_failed")

    if kmeanspp_df is None:
        out = random_df.select("algo_type", *cols, failed(random_df))
    else:
        out = (random_df.select(F.lit(ALGO_RANDOM).alias("algo_type"), *cols, failed(random_df))
               .unionByName(kmeanspp_df.select(F.lit(ALGO_KMEANSPP).alias("algo_type"), *cols,
                                               failed(kmeanspp_df))))
    out = out.orderBy("_failed", F.col("simple_silhouette").desc_nulls_first(), "algo_type", "num_clusters")
    return (out.limit(1) if best else out).drop("_failed")


# ---------------------------------------------------------------- models as tables
def _model_rows(models) -> tuple[list[int], int, object]:
    """Labels of the models, their dimension, and a function that yields their
    centroids in order, read again for each call (a table is never held whole)."""
    if isinstance(models, DataFrame):
        checkpoint_dir(models.sparkSession)
        # numbered once: a second reading must not meet the models in another order
        rows = models.select(F.monotonically_increasing_id().alias("_m"), "num_clusters",
                             "centroids").checkpoint(eager=True)
        heads = sorted(tuple(r) for r in rows.select(
            "_m", "num_clusters", F.size(F.get("centroids", F.lit(0))).alias("d")).collect())
        number = {h[0]: i for i, h in enumerate(heads)}
        d = max((h[2] or 0 for h in heads), default=0)
        each = rows.select("_m", F.posexplode("centroids").alias("at", "c")).orderBy("_m", "at")

        def read():
            for r in each.toLocalIterator():
                yield number[r["_m"]], r["at"], r["c"]

        return [h[1] for h in heads], d, read
    held = [(int(k), [[float(v) for v in c] for c in cs]) for k, cs in models]

    def given():
        for i, (_, cs) in enumerate(held):
            for at, c in enumerate(cs):
                yield i, at, c

    return [k for k, _ in held], next((len(c) for _, cs in held for c in cs), 0), given


def _read_blocks(read, d: int) -> Iterator[list[_Part]]:
    """Blocks of at most ``BLOCK_BYTES`` as the centroids are read."""
    most = max(1, BLOCK_BYTES // max(1, d * 8))
    block: list[_Part] = []
    rows: list = []
    at_m, first, used = None, 0, 0

    def close():
        if rows:
            block.append(_Part(at_m, first, np.array(rows, dtype=np.float64).reshape(len(rows), d)))
    for m, at, c in read():
        if len(c) != d:
            raise ValueError(f"centroids must all have {d} elements")
        if m != at_m or used >= most:
            close()
            rows, at_m, first = [], m, at
            if used >= most:
                yield block
                block, used = [], 0
        rows.append(c)
        used += 1
    close()
    if block:
        yield block


def bounded_models(models, max_values: int = 8_000_000) -> list[tuple[int, list]]:
    """``[(num_clusters, centroids)]`` from a model DataFrame or list, for models small
    enough to be column literals (``models_column``); checks their number of values."""
    if isinstance(models, DataFrame):
        size = models.select(F.sum(F.size(F.flatten("centroids"))).alias("s")).first()["s"] or 0
        if size > max_values:
            raise ValueError(f"{size} centroid values exceed the bound {max_values}")
        models = [(r["num_clusters"], r["centroids"]) for r in
                  models.select("num_clusters", "centroids").collect()]
    models = [(int(k), [[float(v) for v in c] for c in cs]) for k, cs in models]
    if sum(len(cs) * (len(cs[0]) if cs else 0) for _, cs in models) > max_values:
        raise ValueError("centroid values exceed the bound")
    return models


def models_column(models) -> "F.Column":
    """The models as one ``array<struct<num_clusters, centroids>>`` constant for column
    expressions (``closest_columns``): a single literal, however many values it has."""
    import json
    kind = "array<struct<num_clusters:int,centroids:array<array<double>>>>"
    text = json.dumps([{"num_clusters": int(k), "centroids": [[float(v) for v in c] for c in cs]}
                       for k, cs in models])
    return F.from_json(F.lit(text), kind)


def closest_to(df: DataFrame, features_col: str, models, m: int = 2,
               metric: str = "squared_dist_norm2") -> DataFrame:
    """Every row of ``df`` with ``closest``: per model (a DataFrame or list of
    ``(num_clusters, centroids)``, of any size) ``struct(num_clusters, column_ids,
    distances)`` of the ``m`` nearest centroids, ascending, ties to the lower index.
    NULL for vectors that are NULL or hold one."""
    labels, d, read = _model_rows(models)
    spark = df.sparkSession
    ship_package(spark)
    far = F.sqrt if metric_name(metric) == "dist_norm2" else (lambda c: c)
    x = F.col(qcol(features_col)).cast("array<double>")
    whole = F.coalesce(F.forall(x, lambda v: v.isNotNull()), F.lit(False))
    rows = df.select(F.struct(*[F.col(qcol(c)) for c in df.columns]).alias("row"),
                     F.when(whole, x).otherwise(F.array_repeat(F.lit(0.0), d)).alias("x"), whole.alias("whole"))
    seen = nearest(rows, _read_blocks(read, d), len(labels), m, d)
    some = F.transform(F.sequence(F.lit(0), F.lit(len(labels) - 1)), lambda i: F.struct(
        F.element_at(F.lit(labels), i + 1).alias("num_clusters"),
        F.filter(F.slice("near", i * m + 1, m), lambda v: v >= 0).alias("column_ids"),
        F.transform(F.filter(F.slice("dist", i * m + 1, m), lambda v: v < float("inf")), far).alias("distances")))
    return seen.select("row.*", F.when(F.col("whole"), some).alias("closest"))


def simple_silhouette(df: DataFrame, features_col: str, models,
                      metric: str = "squared_dist_norm2") -> DataFrame:
    """``num_clusters, simple_silhouette`` of every model (a DataFrame or list of
    ``(num_clusters, centroids)``, of any size): ``avg((d2 - d1) / d2)`` over the
    points, 0 when d2 = 0, NULL for one centroid. Each task scores its points
    against the models in NumPy, a block of centroids per pass, and returns
    per-model partial sums."""
    metric = metric_name(metric)
    labels, d, read = _model_rows(models)
    spark = df.sparkSession
    ship_package(spark)
    schema = "num_clusters int, simple_silhouette double"
    if not labels:
        return spark.createDataFrame([], schema)
    points = prepare_points(df.withColumn("_id", F.lit(None).cast("int")), "_id", features_col)
    if points.isEmpty():
        return spark.createDataFrame([(k, None) for k in labels], schema)
    shape = shape_of(points)
    if shape.d != d:
        raise ValueError(f"feature vectors have {shape.d} elements, the models {d}")
    counted: dict = {}

    def counting():
        for i, at, c in read():
            counted[i] = at + 1
            yield i, at, c

    # distances to model centroids may exceed those between points: the grid covers both
    top = max((abs(v) for _, _, c in read() for v in c), default=0.0)
    shape.exp = np.maximum(shape.exp, reduction.exponents(np.array([top])))
    scores = _scored(points, _read_blocks(counting, d), len(labels), shape, metric)
    rows = []
    for i, k in enumerate(labels):
        s = scores.get(i)
        rows.append((k, s["sil"] / s["n"] if s and counted.get(i, 0) >= 2 else None))
    return spark.createDataFrame(rows, schema)
