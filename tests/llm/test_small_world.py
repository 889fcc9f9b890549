"""Small-world search of near-duplicate vectors against all pairs compared."""

import numpy as np
import pytest

from sparkprep.llm import small_world
from sparkprep.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, links string, component string"


def brute(vectors, ids, least=0.9):
    """(id, links, component, kept) in the order of the rows."""
    n = len(vectors)
    ok = [i for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and any(v)]
    near = np.zeros((n, n), bool)
    for i in ok:
        for j in ok:
            if i < j and len(vectors[i]) == len(vectors[j]):
                a, b = np.float64(vectors[i]), np.float64(vectors[j])
                near[i, j] = near[j, i] = a @ b / np.sqrt((a @ a) * (b @ b)) >= least
    label = np.arange(n)
    for _ in range(n):
        before = label.copy()
        for i in ok:
            label[i] = min(label[i], *label[near[i]]) if near[i].any() else label[i]
        if (label == before).all():
            break
    least_id = {c: min((ids[i] for i in range(n) if label[i] == c and ids[i] is not None), default=None) for c in label}
    return sorted(((ids[i], int(near[i].sum()), least_id[label[i]], ids[i] == least_id[label[i]]) for i in range(n)), key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def planted(seed=5, n=900, d=16):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=d).astype(np.float32) for _ in range(n)]
    for i in range(0, 60):  # near copies on both sides of the limit
        out.append((out[i] + rng.normal(size=d) * 0.05 * (i % 12)).astype(np.float32))
    out += [(out[100] * (1 + i / 7) + rng.normal(size=d) * 0.01).astype(np.float32) for i in range(300)]  # a large group
    out += [out[200]] * 40  # equal vectors
    return [v.tolist() for v in out]


def test_given_table(spark):
    given = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    want = brute([r["embedding"] for r in given], [r["vec_id"] for r in given])
    assert rows(QUERIES["op12_near_vectors"](spark, SF_SMALL)) == want


def test_planted_groups_over_shards(spark):
    vectors = planted()
    ids = [(7 * i) % 10_007 for i in range(len(vectors))]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in zip(ids, vectors)], SCHEMA).repartition(5)
    want = {r[0]: r for r in brute(vectors, ids)}
    got = rows(small_world.classes(df, shards=3))
    assert len(got) == len(want)
    assert sum(r[1] for r in got) >= 0.995 * sum(r[1] for r in want.values())
    assert all(r[1] <= want[r[0]][1] for r in got)  # none below the threshold
    assert np.mean([r[2:] == want[r[0]][2:] for r in got]) >= 0.995
    # in the background two random vectors of 16 entries may link: few, so nearly all rows agree exactly
    assert np.mean([r == want[r[0]] for r in got]) >= 0.99


def test_odd_rows(spark):
    base = [1.0, 2.0, 3.0]
    vectors = [base, base, [2.0, 4.0, 6.0], None, [], [0.0] * 3, [1.0, None, 3.0], [float("nan")] * 3,
               [float("inf"), 1.0, 1.0], [1.0, 2.0], [-1.0, -2.0, -3.0], base, [3.0, 1.0, -9.0], [3.0, 1.0, -9.0],
               [3e38, 1e38, -9e38 / 3]]
    ids = [5, 5, 3, 1, 1, None, 9, 10, 11, 12, 13, None, None, None, 20]
    df = spark.createDataFrame([(i, v, None, None, None) for i, v in zip(ids, vectors)], SCHEMA)
    want = [(i, n, c, k) for i, n, c, k in brute(vectors, ids)]
    assert rows(small_world.classes(df, shards=2)) == sorted(want, key=str)
    assert small_world.classes(df.limit(0)).collect() == []
    assert rows(small_world.classes(df.limit(1))) == [(5, 0, 5, True)]


def test_audit_widens_the_beam_and_falls_back():
    rng = np.random.default_rng(1)
    x = small_world.unit(rng.normal(size=(1500, 24)))
    level = np.sort((rng.random(1500) < 0.08).astype(np.int64))[::-1]
    graph = small_world.built(x.astype(np.float32), level)
    assert small_world.audited(graph, x, np.arange(1500), 0.9) in (32, 64, 128, 256)
    graph.layers[0][:] = -1  # a graph without links finds nothing: brute force
    assert small_world.audited(graph, x, np.arange(1500), 0.9) == 0
    found = sum(len(r) for r, _ in small_world._found(graph, 0, x, x, 0.9))
    assert found == int((x @ x.T >= 0.9).sum())


@pytest.mark.parametrize("size", [1, 2, 40, 700])
def test_every_node_is_found_by_itself(size):
    rng = np.random.default_rng(size)
    x = small_world.unit(rng.normal(size=(size, 8)))
    graph = small_world.built(x.astype(np.float32), np.sort(rng.integers(0, 3, size))[::-1])
    found = {(int(a), int(b)) for r, c in small_world._found(graph, 64, x, x, 0.999999) for a, b in zip(r, c)}
    assert {(i, i) for i in range(size)} <= found
