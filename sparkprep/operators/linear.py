"""Least squares and per-group ridge regression from distributed statistics.

No group is ever gathered: each model is fitted from its group's n, means and
covariances (one partially aggregated pass), solved per group in
``mapInPandas`` over the statistics table, so a group holding a third of all
rows costs the same shuffle as any other. ``grouped_train`` runs a user's trainer
per group: from mergeable partial states, or whole groups streamed to it in batches.
"""

from __future__ import annotations

import socket
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.constants import RIDGE_ALPHA
from sparkprep.operators import linalg
from sparkprep.operators.gram import Moments, gram_stats, vector_elements
from sparkprep.operators.schema import qcol
from sparkprep.session import ship_package


def _xs(df, features, p):
    if isinstance(features, str):
        if p is None:
            first = df.select(F.size(qcol(features)).alias("s")).filter("s >= 0").head()
            p = int(first[0]) if first else 0
        return vector_elements(features, p)
    return [F.col(qcol(c)).cast("double") for c in features]


def linregr(df: DataFrame, target_col: str, features, intercept: bool = False,
            p: int | None = None) -> DataFrame:
    """OLS of ``target_col`` on ``features`` over complete rows.

    ``features`` is a list of columns or an array column (``p`` elements,
    read from the first row when not given). Without intercept the features
    are used as passed; ``r2 = 1 - RSS / TSS`` with TSS centred. Returns one
    row ``coef array<double>, intercept double, r2 double, num_rows long``.
    """
    xs = _xs(df, features, p)
    p = len(xs)
    y = F.col(qcol(target_col)).cast("double")
    m = Moments.of(gram_stats(df, xs + [y]).first())
    cp = m.centred() if intercept else m.raw()
    if m.n == 0:
        coef, b, r2 = [None] * p, None, None
    else:
        coef_a, rss = linalg.regress(cp, p, list(range(p)))
        tss = m.n * m.cov[p, p]
        r2 = float(1.0 - rss / tss) if tss > 0 else None
        coef = [float(c) for c in coef_a]
        b = float(m.means[p] - m.means[:p] @ coef_a) if intercept else 0.0
    return df.sparkSession.createDataFrame(
        [(coef, b, r2, m.n)], "coef array<double>, intercept double, r2 double, num_rows long")


def _result_schema(df: DataFrame, key: str, extra: list[T.StructField]) -> T.StructType:
    kt = df.schema[key].dataType
    return T.StructType([T.StructField(key, kt), *extra,
                         T.StructField("hostname", T.StringType()),
                         T.StructField("coef", T.ArrayType(T.DoubleType())),
                         T.StructField("intercept", T.DoubleType()),
                         T.StructField("r_square", T.DoubleType())])


def _ridge_solver(key: str, alpha: float, extra: list[str]):
    host = None

    def value(col, i):
        v = col.iat[i]
        return None if v is None or (isinstance(v, float) and np.isnan(v)) else v

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nonlocal host
        host = host or socket.gethostname()
        for pdf in batches:
            out = []
            for i in range(len(pdf)):
                m = Moments(pdf["n"].iat[i], list(pdf["means"].iat[i]), list(pdf["cov"].iat[i]))
                if m.n == 0:
                    w, b, r2 = None, None, None
                else:
                    w_a, b, r2 = linalg.ridge(m.n, m.means, m.cov, alpha)
                    w = [float(v) for v in w_a]
                out.append([value(pdf[key], i), *[value(pdf[e], i) for e in extra], host, w, b, r2])
            frame = pd.DataFrame(out, columns=[key, *extra, "hostname", "coef", "intercept", "r_square"])
            yield frame.astype({key: object, **{e: object for e in extra}})
    return solve


def ridge_by_group(df: DataFrame, key: str, features_col: str, label_col: str,
                   alpha: float = RIDGE_ALPHA, p: int | None = None) -> DataFrame:
    """One ridge model per ``key`` (intercept unpenalised): ``key, hostname,
    coef, intercept, r_square``. ``hostname`` is where the solve ran."""
    xs = _xs(df, features_col, p)
    y = F.col(qcol(label_col)).cast("double")
    st = gram_stats(df, xs + [y], by=[key])
    schema = _result_schema(df, key, [])
    ship_package(df.sparkSession)
    return st.mapInPandas(_ridge_solver(key, alpha, []), schema)


def ridge_by_group_rows(df: DataFrame, key: str, row_col: str, features_col: str,
                        label_col: str, alpha: float = RIDGE_ALPHA,
                        p: int | None = None) -> DataFrame:
    """As ``ridge_by_group``, reported at each model's last row:
    ``key, current_row, final_row, segment_id, hostname, coef, intercept, r_square``.
    The final row is the largest of all rows of the model, complete or not."""
    xs = _xs(df, features_col, p)
    y = F.col(qcol(label_col)).cast("double")
    st = gram_stats(df, xs + [y], by=[key],
                    extra_aggs=[F.max(F.col("_row")).cast("long").alias("final_row")],
                    extra_inputs=[F.col(qcol(row_col)).alias("_row")])
    st = st.withColumn("current_row", F.col("final_row")).withColumn(
        "segment_id", F.spark_partition_id())
    schema = _result_schema(df, key, [T.StructField("current_row", T.LongType()),
                                      T.StructField("final_row", T.LongType()),
                                      T.StructField("segment_id", T.IntegerType())])
    ship_package(df.sparkSession)
    return st.mapInPandas(_ridge_solver(key, alpha, ["current_row", "final_row", "segment_id"]),
                          schema)


class MergeableTrainer:
    """A model per group from states that merge, so that a group of any size is trained by
    all tasks that hold its rows.

    ``state_schema`` and ``result_schema`` are DDL texts (without the key). ``partial(state, rows)``
    adds an Arrow table of a group's rows to a state (None at first) and returns it;
    ``merge(a, b)`` joins two; ``finish(state)`` gives the result. States and results are
    dictionaries of plain values as the schemas name them; neither may grow with the rows.
    """

    state_schema: str
    result_schema: str

    def partial(self, state: dict | None, rows: pa.Table) -> dict | None:
        raise NotImplementedError

    def merge(self, a: dict, b: dict) -> dict:
        raise NotImplementedError

    def finish(self, state: dict) -> dict:
        raise NotImplementedError


#: States a task holds before it passes them on; buckets over which a key's states are merged first.
HELD_GROUPS, BUCKETS = 10_000, 64


def _known(values: tuple) -> tuple:
    """A key whose parts compare equal where Spark groups them together."""
    return tuple("NaN" if isinstance(v, float) and v != v else repr(v) if isinstance(v, (list, dict)) else v
                 for v in values)


def _train_states(df: DataFrame, keys: list[str], trainer: MergeableTrainer) -> DataFrame:
    """One row per task and group: the keys, ``_pid``, and the state's columns."""
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    state = T.StructType.fromDDL(trainer.state_schema)
    out = T.StructType([*[df.schema[k] for k in keys], T.StructField("_pid", T.LongType()), *state.fields])
    arrow = to_arrow_schema(out)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        pid = TaskContext.get().partitionId()

        def rows():
            return pa.RecordBatch.from_pylist(
                [{**dict(zip(keys, values)), "_pid": pid, **st} for values, st in held.values() if st is not None],
                schema=arrow)

        for b in batches:
            if not b.num_rows:
                continue
            table = pa.Table.from_batches([b])
            at = table.select(keys).append_column("_i", pa.array(range(b.num_rows)))
            # the rows of each group in this batch, in their order
            for g in at.group_by(keys, use_threads=False).aggregate([("_i", "list")]).to_pylist():
                values = tuple(g[k] for k in keys)
                old = held.get(_known(values), (values, None))[1]
                held[_known(values)] = (values, trainer.partial(old, table.take(pa.array(g["_i_list"]))))
            if len(held) > HELD_GROUPS:
                yield rows()
                held.clear()
        yield rows()

    return df.mapInArrow(train, out)


def _merge_states(states: DataFrame, keys: list[str], trainer: MergeableTrainer, by: list[str],
                  schema: T.StructType, done: Callable[[tuple, dict], dict]) -> DataFrame:
    """Neighbouring states of equal ``by`` merged as they stream by: one is held at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    names = T.StructType.fromDDL(trainer.state_schema).names

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, row, held = None, None, None
        for b in batches:
            out = []
            for r in b.to_pylist():
                here = _known(tuple(r[c] for c in by))
                state = {c: r[c] for c in names}
                if here == now:
                    held = trainer.merge(held, state)
                    continue
                if now is not None:
                    out.append(done(row, held))
                now, row, held = here, r, state
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if now is not None:
            yield pa.RecordBatch.from_pylist([done(row, held)], schema=arrow)

    names_by = [qcol(c) for c in by]
    return (states.repartition(*[F.col(c) for c in names_by])
            .sortWithinPartitions(*[F.col(c) for c in names_by], "_pid").mapInArrow(fold, schema))


def _train_mergeable(df: DataFrame, keys: list[str], trainer: MergeableTrainer) -> DataFrame:
    """States per task and group, merged over salted buckets of tasks, then over buckets: no
    task holds more than one state of a group, and none reads all rows of a hot one."""
    states = _train_states(df, keys, trainer)
    bucketed = T.StructType([*states.schema.fields, T.StructField("_bucket", T.LongType())])
    salted = states.withColumn("_bucket", F.pmod(F.col("_pid"), F.lit(BUCKETS)))
    first = _merge_states(salted, keys, trainer, [*keys, "_bucket"], bucketed,
                          lambda row, st: {**row, **st, "_pid": row["_bucket"]})
    result = T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL(trainer.result_schema).fields])
    return _merge_states(first, keys, trainer, keys, result,
                         lambda row, st: {**{k: row[k] for k in keys}, **trainer.finish(st)})


def grouped_train(df: DataFrame, key, fn: Callable | MergeableTrainer, schema=None) -> DataFrame:
    """A model per group, all groups in parallel.

    A ``MergeableTrainer`` works on partial states: rows stay where they are, and a group that
    holds most rows uses all tasks. Any other ``fn(key_tuple, Iterator[pd.DataFrame]) ->
    Iterator[pd.DataFrame]`` (with ``schema``) gets each group whole, as a stream of batches in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ship_package(df.sparkSession)
    if isinstance(fn, MergeableTrainer):
        return _train_mergeable(df, keys, fn)
    return df.groupBy(*keys).applyInPandas(fn, schema)


class RidgeTrainer(MergeableTrainer):
    """Ridge with an unpenalised intercept from counts, means and centred products, which
    merge without loss (rows with a NULL or NaN are skipped; a group without any has NULLs)."""

    state_schema = "n long, means array<double>, products array<double>"
    result_schema = "hostname string, coef array<double>, intercept double, r_square double"

    def __init__(self, features_col: str, label_col: str, alpha: float = RIDGE_ALPHA):
        self.features_col, self.label_col, self.alpha = features_col, label_col, alpha

    def partial(self, state: dict | None, rows: pa.Table) -> dict:
        x = rows[self.features_col].combine_chunks()
        wide = max((v for v in pc.list_value_length(x).to_pylist() if v is not None), default=0)
        if x.null_count == 0 and x.flatten().null_count == 0 and len(x.flatten()) == wide * len(x):
            z = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), wide)
        else:
            z = np.array([[*(np.nan if e is None else e for e in v or ()), *([np.nan] * (wide - len(v or ())))]
                          for v in x.to_pylist()], dtype=np.float64).reshape(len(x), wide)
        y = rows[self.label_col].cast(pa.float64()).to_numpy().copy()
        y[x.is_null().to_numpy(zero_copy_only=False)] = np.nan  # a row without features
        z = np.column_stack([z, y])
        z = z[~np.isnan(z).any(axis=1)]
        means = z.mean(axis=0) if len(z) else np.zeros(0)
        d = z - means if len(z) else np.zeros((0, 0))
        new = {"n": len(z), "means": means.tolist(), "products": (d.T @ d).ravel().tolist()}
        return new if state is None else self.merge(state, new)

    def merge(self, a: dict, b: dict) -> dict:
        if not a["n"] or not b["n"]:
            return a if a["n"] else b
        n = a["n"] + b["n"]
        ma, mb = np.array(a["means"]), np.array(b["means"])
        if len(ma) != len(mb):
            raise ValueError("feature vectors of one group differ in length")
        move = mb - ma
        products = (np.array(a["products"]) + np.array(b["products"])
                    + (np.outer(move, move) * (a["n"] * b["n"] / n)).ravel())
        return {"n": n, "means": (ma + move * (b["n"] / n)).tolist(), "products": products.tolist()}

    def finish(self, state: dict) -> dict:
        host = socket.gethostname()
        if not state["n"]:
            return {"hostname": host, "coef": None, "intercept": None, "r_square": None}
        means = np.array(state["means"])
        cov = np.array(state["products"]).reshape(len(means), -1) / state["n"]
        w, b, r2 = linalg.ridge(state["n"], means, cov, self.alpha)
        return {"hostname": host, "coef": [float(v) for v in w], "intercept": b, "r_square": r2}


def streaming_ridge_trainer(key: str, features_col: str, label_col: str,
                            alpha: float = RIDGE_ALPHA):
    """A ``grouped_train`` function fitting ridge from running shifted sums, so a
    group of any size streams through in constant memory."""

    def train(k: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, shift, s1, s2 = 0, None, None, None
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.array(pdf[features_col].tolist(), dtype=np.float64)
            z = np.column_stack([x, pdf[label_col].to_numpy(dtype=np.float64)])
            z = z[~np.isnan(z).any(axis=1)]
            if not len(z):
                continue
            if shift is None:
                shift = z.mean(axis=0)
                s1 = np.zeros(z.shape[1])
                s2 = np.zeros((z.shape[1], z.shape[1]))
            d = z - shift
            n += len(d)
            s1 += d.sum(axis=0)
            s2 += d.T @ d
        if n == 0:
            yield pd.DataFrame([[k[0], socket.gethostname(), None, None, None]],
                               columns=[key, "hostname", "coef", "intercept", "r_square"])
            return
        mu = s1 / n
        cov = s2 / n - np.outer(mu, mu)
        w, b, r2 = linalg.ridge(n, shift + mu, cov, alpha)
        yield pd.DataFrame([[k[0], socket.gethostname(), [float(v) for v in w], b, r2]],
                           columns=[key, "hostname", "coef", "intercept", "r_square"])
    return train
