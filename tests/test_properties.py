"""Property tests: column functions against plain-Python definitions, many
generated cases per Spark job."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkprep.functions import filter_array_at_index, format_bytes, hash_uniform

CASES = settings(max_examples=1, deadline=None)

arrays = st.lists(st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32)),
                  max_size=8)


@CASES
@given(st.lists(st.tuples(arrays, st.integers(min_value=1, max_value=10)), min_size=50, max_size=200))
def test_filter_array_at_index_is_python_slicing(spark, cases):
    df = spark.createDataFrame([(i, a, k) for i, (a, k) in enumerate(cases)],
                               "i int, a array<double>, k int")
    got = {r["i"]: r["f"] for r in df.select("i", filter_array_at_index("a", F.col("k")).alias("f")).collect()}
    for i, (a, k) in enumerate(cases):
        assert got[i] == a[:k - 1] + a[k:]


def _py_uniform(key, seed):
    h = hashlib.md5(f"{key}:{seed}".encode()).hexdigest()
    return (int(h[:13], 16) + 0.5) / 2 ** 52


@CASES
@given(st.lists(st.integers(min_value=-2 ** 62, max_value=2 ** 62), min_size=50, max_size=300),
       st.integers(min_value=0, max_value=10 ** 6))
def test_hash_uniform_is_md5_prefix(spark, keys, seed):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r["u"] for r in df.select(hash_uniform("k", seed=seed).alias("u")).collect()]
    for k, u in zip(keys, got):
        assert 0.0 < u < 1.0
        assert u == _py_uniform(k, seed)


def _py_format(b):
    units = ["bytes", "kB", "MB", "GB", "TB", "PB"]
    for p in range(len(units) - 1, 0, -1):
        if b >= 10 * 1024 ** p:
            return f"{int(b / 1024 ** p + 0.5)} {units[p]}"
    return f"{int(b)} bytes"


@CASES
@given(st.lists(st.integers(min_value=0, max_value=2 ** 52), min_size=50, max_size=300))
def test_format_bytes_rule(spark, sizes):
    sizes = sizes + [0, 10239, 10240, 10 * 1024 ** 2 - 1, 10 * 1024 ** 2, 10 * 1024 ** 3]
    df = spark.createDataFrame([(s,) for s in sizes], "b long")
    got = [r["t"] for r in df.select(format_bytes("b").alias("t")).collect()]
    assert got == [_py_format(s) for s in sizes]
