"""Running totals per key in a given order, without placing a key in one task.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to a single
task; a key holding a third of the table would then be one task. Instead:

1. range-partition on ``(key, order...)`` and sort within partitions, so a hot
   key is spread over consecutive partitions; the sorted frame is checkpointed
   to the shared checkpoint folder (fixes its partitioning, survives executor
   loss, cuts lineage);
2. one ``mapInArrow`` pass returns a summary per partition (first/last key,
   total of the trailing key run): one row per partition reaches the driver;
3. the driver turns those into a carry-in offset per partition (and whether the
   last run goes on in the next one, to flag each key's last row);
4. a second ``mapInArrow`` pass computes the local segmented cumulative sum plus
   the carry. Both passes stream Arrow batches; nothing is gathered by key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.operators.schema import qcol
from sparkprep.session import checkpoint_dir, ship_package


def _equal(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether the rows of both are the same key: NULL equals NULL, NaN equals NaN."""
    if pa.types.is_nested(a.type):  # pyarrow compares no nested values
        return np.array([repr(x) == repr(y) for x, y in zip(a.to_pylist(), b.to_pylist())], dtype=bool)
    same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
    both = (pc.is_null(a, nan_is_null=False).to_numpy(zero_copy_only=False)
            & pc.is_null(b, nan_is_null=False).to_numpy(zero_copy_only=False))
    if pa.types.is_floating(a.type):
        both |= np.logical_and(pc.fill_null(pc.is_nan(a), False).to_numpy(zero_copy_only=False),
                               pc.fill_null(pc.is_nan(b), False).to_numpy(zero_copy_only=False))
    return same | both


def _runs(keys: list[pa.Array]) -> np.ndarray:
    """Start index of every run of equal keys (all key columns) in a sorted batch."""
    n = len(keys[0])
    if n <= 1:
        return np.zeros(n, dtype=np.int64)
    change = np.zeros(n - 1, dtype=bool)
    for col in keys:
        a, b = col.slice(1), col.slice(0, n - 1)
        change |= ~_equal(a, b)
    return np.concatenate([[0], np.nonzero(change)[0] + 1]).astype(np.int64)


def _key_at(keys: list[pa.Array], i: int) -> list[pa.Array]:
    return [col.slice(i, 1) for col in keys]


def _same_key(a: list[pa.Array], b: list[pa.Array]) -> bool:
    return all(_equal(x, y)[0] for x, y in zip(a, b))


def _plain(key) -> tuple:
    """A collected key whose parts compare equal when Spark groups them together."""
    return tuple("NaN" if isinstance(v, float) and v != v else 0.0 if isinstance(v, float) and v == 0
                 else repr(v) if isinstance(v, (tuple, list, dict)) else v for v in key)


def _values(b: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(b.column("_v"), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _summarize_fn(key: list[str], schema: pa.Schema):
    def summarize(batches):
        pid = TaskContext.get().partitionId()
        seen, single = False, True
        first = last = None
        total = last_total = 0
        for b in batches:
            if b.num_rows == 0:
                continue
            keys, vals = [b.column(k) for k in key], _values(b)
            starts = _runs(keys)
            k0, kl = _key_at(keys, 0), _key_at(keys, b.num_rows - 1)
            continues = seen and _same_key(k0, last)
            if not seen:
                first = k0
            single = single and len(starts) == 1 and (continues or not seen)
            tail = int(vals[starts[-1]:].sum())
            last_total = last_total + tail if (len(starts) == 1 and continues) else tail
            total += int(vals.sum())
            last, seen = kl, True
        if seen:
            def struct(values):
                kind = schema.field("first_key").type
                return pa.StructArray.from_arrays([v.cast(kind.field(i).type) for i, v in enumerate(values)],
                                                  fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), struct(first), struct(last), pa.array([single]),
                 pa.array([total], pa.int64()), pa.array([last_total], pa.int64())], schema=schema)
    return summarize


def _carry_in(summaries) -> tuple[dict, dict]:
    """Per partition, the running total carried into its first run; and whether its last
    run goes on in the following non-empty partition. Both are decided here, among
    summaries: a key collected by the driver is never compared with a worker's."""
    carries, goes_on = {}, {}
    carry_key, carry_val, prev = None, 0, None
    for s in summaries:
        first, last = _plain(s["first_key"]), _plain(s["last_key"])
        meets = prev is not None and first == carry_key
        carries[s["pid"]] = carry_val if meets else 0
        if prev is not None:
            goes_on[prev] = meets
        carry_key = last
        carry_val = carries[s["pid"]] + s["total"] if s["single"] else s["last_total"]
        prev = s["pid"]
    return carries, goes_on


def _apply_fn(key: list[str], out: str, last_flag: str | None, carries: dict, goes_on: dict):
    def finish(held, continued):
        b, cum, flags, _ = held
        if last_flag:
            flags[-1] = not continued
        return _with_cols(b, out, cum, last_flag, flags)

    def apply(batches):
        pid = TaskContext.get().partitionId()
        carry = carries.get(pid, 0)
        held = None
        for b in batches:
            if b.num_rows == 0:
                continue
            keys, vals = [b.column(k) for k in key], _values(b)
            starts = _runs(keys)
            cs = np.cumsum(vals)
            continued = held is None or _same_key(_key_at(keys, 0), held[3])
            # what each run starts from: the carry for the first, if it goes on
            bases = -np.where(starts > 0, cs[starts - 1], 0)
            bases[0] = carry if continued else 0
            cum = cs + np.repeat(bases, np.diff(np.append(starts, len(vals))))
            flags = None
            if last_flag:
                flags = np.zeros(len(vals), dtype=bool)
                flags[starts[1:] - 1] = True
            if held is not None:
                yield finish(held, continued)
            held = (b, cum, flags, _key_at(keys, b.num_rows - 1))
            carry = int(cum[-1])
        if held is not None:
            yield finish(held, goes_on.get(pid, False))
    return apply


def running_totals(df: DataFrame, key, order: list[str], value, out: str = "cum",
                   last_flag: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = inclusive running sum of ``value`` within ``key`` (a
    column name or a list of them) in ``order`` (give a total order: ties are
    otherwise broken arbitrarily), and optionally ``last_flag`` marking each
    key's last row. ``value`` is a column name or an integer expression; NULL
    counts as 0, and NULL keys form one group."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    ship_package(spark)
    keys = [key] if isinstance(key, str) else list(key)
    val = F.col(value) if isinstance(value, str) else value
    ordering = [F.col(qcol(k)) for k in keys] + [F.col(qcol(o)) for o in order]
    base = df.withColumn("_v", val.cast("long"))
    # Without an explicit count the range partitions start at
    # spark.sql.shuffle.partitions and AQE merges adjacent small ones (range
    # order is kept), so the task count follows the data size while a hot
    # key's full-size partitions stay separate.
    ranged = (base.repartitionByRange(num_partitions, *ordering) if num_partitions
              else base.repartitionByRange(*ordering))
    sorted_df = ranged.sortWithinPartitions(*ordering).checkpoint(eager=True)
    key_type = T.StructType([T.StructField(k, sorted_df.schema[k].dataType) for k in keys])
    summ_schema = T.StructType([T.StructField("pid", T.IntegerType()),
                                T.StructField("first_key", key_type),
                                T.StructField("last_key", key_type),
                                T.StructField("single", T.BooleanType()),
                                T.StructField("total", T.LongType()),
                                T.StructField("last_total", T.LongType())])
    arrow_summ = pa.schema([pa.field(f.name, _arrow_type(f.dataType)) for f in summ_schema])
    summaries = sorted(sorted_df.select(*[qcol(k) for k in keys], "_v")
                       .mapInArrow(_summarize_fn(keys, arrow_summ), summ_schema).collect(),
                       key=lambda r: r["pid"])
    carries, goes_on = _carry_in(summaries)
    fields = list(sorted_df.schema.fields) + [T.StructField(out, T.LongType())]
    if last_flag:
        fields.append(T.StructField(last_flag, T.BooleanType()))
    return (sorted_df.mapInArrow(_apply_fn(keys, out, last_flag, carries, goes_on),
                                 T.StructType(fields))
            .drop("_v"))


def _with_cols(b: pa.RecordBatch, out: str, cum, last_flag, flags) -> pa.RecordBatch:
    arrays = list(b.columns) + [pa.array(cum, type=pa.int64())]
    names = list(b.schema.names) + [out]
    if last_flag:
        arrays.append(pa.array(flags, type=pa.bool_()))
        names.append(last_flag)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _arrow_type(dt):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(dt)
