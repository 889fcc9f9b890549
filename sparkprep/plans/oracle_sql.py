"""DuckDB SQL generators for the oracle side of iterative operators.

Linear solves are unrolled SWEEP steps over an ``(g, r, c, v)`` matrix CTE
(``g`` = independent problem, e.g. a group or a VIF candidate); the same
pivot-skip tolerance as ``operators.linalg``. Everything is plain SQL over the
registered tables, generated from parameters, so any p works without NumPy.
"""

from __future__ import annotations

from sparkprep.constants import KMEANS_MAX_ITER, KMEANS_MIN_FRAC_REASSIGNED
from sparkprep.operators import linalg

TOL = repr(linalg.TOL)
FIT = repr(linalg.PERFECT_FIT)


def sweep_ctes(prefix: str, base: str, pivots: list[int], active=None) -> tuple[list[str], str]:
    """CTEs sweeping ``base`` on ``pivots`` in order. ``active(k)`` is an extra
    SQL condition (may use ``m.g``). Returns (ctes, final matrix CTE name);
    pivot CTE ``{prefix}_p{k}`` has ``g, d, act``."""
    ctes = [f"{prefix}_d0 AS MATERIALIZED (SELECT g, r AS k, v AS d0 FROM {base} WHERE r = c)"]
    prev = base
    for k in pivots:
        cond = active(k) if active else "TRUE"
        piv = f"{prefix}_p{k}"
        ctes.append(
            f"{piv} AS MATERIALIZED (SELECT m.g, m.v AS d, coalesce(({cond}) AND d0.d0 > 0 "
            f"AND m.v > {TOL} * d0.d0, FALSE) AS act FROM {prev} m JOIN {prefix}_d0 d0 "
            f"ON d0.g = m.g AND d0.k = {k} WHERE m.r = {k} AND m.c = {k})")
        cur = f"{prefix}_m{k}"
        ctes.append(
            f"""{cur} AS MATERIALIZED (SELECT m.g, m.r, m.c,
            CASE WHEN coalesce(pv.act, FALSE) THEN
                CASE WHEN m.r = {k} AND m.c = {k} THEN -1.0 / pv.d
                     WHEN m.r = {k} OR m.c = {k} THEN m.v / pv.d
                     ELSE m.v - rk.v * kc.v / pv.d END
            ELSE m.v END AS v
            FROM {prev} m LEFT JOIN {piv} pv ON pv.g = m.g
            LEFT JOIN {prev} rk ON rk.g = m.g AND rk.r = m.r AND rk.c = {k}
            LEFT JOIN {prev} kc ON kc.g = m.g AND kc.r = {k} AND kc.c = m.c)""")
        prev = cur
    return ctes, prev


def _unpivot(src: str, id_col: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {id_col} AS id, {j + 1} AS j, CAST({c} AS DOUBLE) AS v FROM {src}"
        for j, c in enumerate(cols))


def vif_steps_sql(src_sql: str, cols: list[str], threshold: float, num_steps: int,
                  id_col: str = "id", scores_only: bool = False, intercept: bool = False) -> str:
    """``step, feature_w_max_vif, vif, discarded`` of the selection loop, or with
    ``scores_only`` the ``feature, vif`` rows of step 0 (vif unrounded). With
    ``intercept`` the regressions use centred cross products."""
    p = len(cols)
    names = " ".join(f"WHEN {j + 1} THEN '{c}'" for j, c in enumerate(cols))
    ctes = [f"f AS MATERIALIZED ({src_sql})",
            f"lg AS MATERIALIZED ({_unpivot('f', id_col, cols)})",
            "s0 AS MATERIALIZED (SELECT j FROM range(1, " + str(p + 1) + ") t(j))",
            f"go0 AS MATERIALIZED (SELECT ({p} >= 2 AND 0 < {num_steps}) AS ok)"]
    steps = 1 if scores_only else max(0, min(num_steps, p - 1))
    outs = []
    for t in range(steps):
        s = f"s{t}"
        ctes += [
            f"rw{t} AS MATERIALIZED (SELECT id FROM lg WHERE j IN (SELECT j FROM {s}) "
            f"GROUP BY id HAVING count(v) = count(*))",
            f"mu{t} AS MATERIALIZED (SELECT j, avg(v) AS m FROM lg WHERE id IN (SELECT id FROM rw{t}) "
            f"AND j IN (SELECT j FROM {s}) GROUP BY j)",
            f"rd{t} AS MATERIALIZED (SELECT j AS r, j AS c, sum(v * v) AS v FROM lg "
            f"WHERE id IN (SELECT id FROM rw{t}) AND j IN (SELECT j FROM {s}) GROUP BY j)",
            (f"gm{t} AS MATERIALIZED (SELECT a.j AS r, b.j AS c, sum((a.v - ma.m) * (b.v - mb.m)) AS v "
             f"FROM lg a JOIN lg b ON a.id = b.id JOIN mu{t} ma ON ma.j = a.j JOIN mu{t} mb ON mb.j = b.j "
             f"WHERE a.id IN (SELECT id FROM rw{t}) GROUP BY a.j, b.j)") if intercept else
            (f"gm{t} AS MATERIALIZED (SELECT a.j AS r, b.j AS c, sum(a.v * b.v) AS v FROM lg a "
             f"JOIN lg b ON a.id = b.id WHERE a.id IN (SELECT id FROM rw{t}) "
             f"AND a.j IN (SELECT j FROM {s}) AND b.j IN (SELECT j FROM {s}) GROUP BY a.j, b.j)"),
            f"ts{t} AS MATERIALIZED (SELECT j, var_pop(v) * count(*) AS tss FROM lg "
            f"WHERE id IN (SELECT id FROM rw{t}) AND j IN (SELECT j FROM {s}) GROUP BY j)",
            f"b{t} AS MATERIALIZED (SELECT sc.j AS g, gm.r, gm.c, gm.v FROM gm{t} gm, {s} sc)",
        ]
        sw, last = sweep_ctes(f"w{t}", f"b{t}", list(range(1, p + 1)),
                              active=lambda k, s=s: f"{k} IN (SELECT j FROM {s}) AND m.g <> {k}")
        ctes += sw
        ctes.append(
            f"vf{t} AS MATERIALIZED (SELECT m.g AS j, CASE WHEN ts.tss <= {FIT} * gd.v THEN NULL "
            f"WHEN m.v <= {FIT} * ts.tss THEN {linalg.VIF_SENTINEL!r} ELSE ts.tss / m.v END AS vif "
            f"FROM {last} m JOIN ts{t} ts ON ts.j = m.g JOIN rd{t} gd ON gd.r = m.g AND gd.c = m.g "
            f"WHERE m.r = m.g AND m.c = m.g)")
        if scores_only:
            return ("WITH " + ",\n".join(ctes) +
                    f"\nSELECT CASE j {names} END AS feature, vif FROM vf0 WHERE vif IS NOT NULL")
        ctes += [
            f"sel{t} AS MATERIALIZED (SELECT j, vif FROM vf{t} WHERE vif IS NOT NULL "
            f"AND (SELECT ok FROM go{t}) ORDER BY vif DESC, j LIMIT 1)",
            f"s{t + 1} AS MATERIALIZED (SELECT j FROM {s} WHERE j NOT IN (SELECT j FROM sel{t}))",
            f"go{t + 1} AS MATERIALIZED (SELECT coalesce((SELECT ok FROM go{t}) AND "
            f"(SELECT vif FROM sel{t}) >= {threshold!r} AND (SELECT count(*) FROM s{t + 1}) >= 2 "
            f"AND {t + 1} < {num_steps}, FALSE) AS ok)",
        ]
        outs.append(f"SELECT {t} AS step, CASE j {names} END AS feature_w_max_vif, vif, "
                    f"vif > {threshold!r} AS discarded FROM sel{t}")
    if not outs:
        return ("SELECT CAST(NULL AS INTEGER) AS step, CAST(NULL AS VARCHAR) AS feature_w_max_vif,"
                " CAST(NULL AS DOUBLE) AS vif, CAST(NULL AS BOOLEAN) AS discarded WHERE FALSE")
    return "WITH " + ",\n".join(ctes) + "\nSELECT * FROM (" + " UNION ALL ".join(outs) + ")"


def linregr_sql(src_sql: str, target: str, features: list[str], id_col: str = "id") -> str:
    """``idx, coef, r2, num_rows`` of no-intercept OLS (coef unrounded)."""
    p = len(features)
    allc = features + [target]
    nn = " AND ".join(f"{c} IS NOT NULL" for c in allc)
    ctes = [f"f AS MATERIALIZED (SELECT * FROM ({src_sql}) WHERE {nn})",
            f"lg AS MATERIALIZED ({_unpivot('f', id_col, allc)})",
            "b AS MATERIALIZED (SELECT 0 AS g, a.j AS r, b.j AS c, sum(a.v * b.v) AS v "
            "FROM lg a JOIN lg b ON a.id = b.id GROUP BY a.j, b.j)"]
    sw, last = sweep_ctes("w", "b", list(range(1, p + 1)))
    ctes += sw
    act = " ".join(f"WHEN {k} THEN (SELECT act FROM w_p{k})" for k in range(1, p + 1))
    ctes.append(f"tss AS (SELECT var_pop(CAST({target} AS DOUBLE)) * count(*) AS t, count(*) AS n FROM f)")
    return ("WITH " + ",\n".join(ctes) +
            f"""
    SELECT CAST(m.r AS BIGINT) AS idx,
           CASE WHEN (CASE m.r {act} END) THEN m.v ELSE 0.0 END AS coef,
           1.0 - (SELECT v FROM {last} WHERE r = {p + 1} AND c = {p + 1}) / tss.t AS r2,
           CAST(tss.n AS BIGINT) AS num_rows
    FROM {last} m, tss WHERE m.c = {p + 1} AND m.r <= {p}""")


def ridge_sql(src_sql: str, key: str, features: list[str], label: str, alpha: float,
              extra_select: str = "", extra_group_cols: str = "") -> str:
    """``key, idx, coef, intercept, r_square`` per group (values unrounded).

    ``src_sql`` has the key, feature expressions and the label; the centred
    cross products come from a two-pass (mean, then centred sums) aggregate.
    """
    p = len(features)
    cols = features + [label]
    nn = " AND ".join(f"({c}) IS NOT NULL" for c in cols)
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS z{i + 1}" for i, c in enumerate(cols))
    means = ", ".join(f"avg(z{i + 1}) AS m{i + 1}" for i in range(p + 1))
    cells = []
    for i in range(1, p + 2):
        for j in range(1, p + 2):
            cells.append(f"SELECT g, {i} AS r, {j} AS c, sum((z{i} - m{i}) * (z{j} - m{j})) AS v "
                         f"FROM d JOIN mu USING (g) GROUP BY g")
    ctes = [f"d AS MATERIALIZED (SELECT {key} AS g, {sel} FROM ({src_sql}) WHERE {nn})",
            f"mu AS MATERIALIZED (SELECT g, count(*) AS n, {means} FROM d GROUP BY g)",
            f"cp AS MATERIALIZED ({' UNION ALL '.join(cells)})",
            f"b AS MATERIALIZED (SELECT g, r, c, v + CASE WHEN r = c AND r <= {p} THEN {alpha!r} "
            f"ELSE 0.0 END AS v FROM cp)"]
    sw, last = sweep_ctes("w", "b", list(range(1, p + 1)))
    ctes += sw
    acts = " ".join(f"LEFT JOIN w_p{k} a{k} ON a{k}.g = m.g" for k in range(1, p + 1))
    actcase = " ".join(f"WHEN {k} THEN a{k}.act" for k in range(1, p + 1))
    ctes.append(f"""wv AS MATERIALIZED (SELECT m.g, m.r AS k,
        CASE WHEN coalesce(CASE m.r {actcase} END, FALSE) THEN m.v ELSE 0.0 END AS w
        FROM {last} m {acts} WHERE m.c = {p + 1} AND m.r <= {p})""")
    mcase = " ".join(f"WHEN {k} THEN mu.m{k}" for k in range(1, p + 1))
    ctes.append(f"""fit AS MATERIALIZED (SELECT mu.g,
        mu.m{p + 1} - sum(wv.w * (CASE wv.k {mcase} END)) AS intercept
        FROM mu JOIN wv ON wv.g = mu.g GROUP BY mu.g, mu.m{p + 1})""")
    ctes.append(f"""q AS MATERIALIZED (SELECT a.g, sum(a.w * b.w * cp.v) AS wxxw
        FROM wv a JOIN wv b ON a.g = b.g JOIN cp ON cp.g = a.g AND cp.r = a.k AND cp.c = b.k
        GROUP BY a.g)""")
    ctes.append(f"""xy AS MATERIALIZED (SELECT wv.g, sum(wv.w * cp.v) AS xyw FROM wv JOIN cp
        ON cp.g = wv.g AND cp.r = wv.k AND cp.c = {p + 1} GROUP BY wv.g)""")
    ctes.append(f"yy AS MATERIALIZED (SELECT g, v AS yy FROM cp WHERE r = {p + 1} AND c = {p + 1})")
    return ("WITH " + ",\n".join(ctes) + f"""
    SELECT wv.g AS {key}, CAST(wv.k AS BIGINT) AS idx, wv.w AS coef, fit.intercept,
           1.0 - (yy.yy - 2.0 * xy.xyw + q.wxxw) / yy.yy AS r_square{extra_select}
    FROM wv JOIN fit USING (g) JOIN q USING (g) JOIN xy USING (g) JOIN yy USING (g)
    {extra_group_cols}""")


# ------------------------------------------------------------------ K-means
def _d2(a: str, b: str) -> str:
    return f"list_sum(list_transform({a}, lambda v, i: (v - {b}[i]) * (v - {b}[i])))"


def kmeans_seed_ctes(points: str, ks: list[int], init: str, seed: int) -> list[str]:
    """CTEs ending in ``c0(k, cid, c)``: initial centroids of every K."""
    from sparkprep.functions.hashing import hash_uniform_sql
    kmax = max(ks)
    klist = ", ".join(str(k) for k in ks)
    ctes = [f"ks AS MATERIALIZED (SELECT unnest([{klist}]) AS k)"]
    if init == "random":
        u = hash_uniform_sql("id", seed=seed)
        ctes.append(f"rk AS MATERIALIZED (SELECT id, x, row_number() OVER (ORDER BY u, id) AS rn "
                    f"FROM (SELECT id, x, {u} AS u FROM {points}))")
        ctes.append("c0 AS MATERIALIZED (SELECT ks.k, CAST(rk.rn - 1 AS INTEGER) AS cid, rk.x AS c "
                    "FROM ks JOIN rk ON rk.rn <= ks.k)")
        return ctes
    for r in range(1, kmax + 1):
        u = hash_uniform_sql("p.id", str(r), seed=seed)
        if r == 1:
            ctes.append(f"pp1 AS MATERIALIZED (SELECT 0 AS cid, x FROM (SELECT p.id, p.x, -ln({u}) AS key "
                        f"FROM {points} p) ORDER BY key, id LIMIT 1)")
        else:
            prev = " UNION ALL ".join(f"SELECT cid, x FROM pp{q}" for q in range(1, r))
            ctes.append(
                f"pp{r} AS MATERIALIZED (SELECT {r - 1} AS cid, x FROM ("
                f"SELECT p.id, p.x, -ln(min({u})) / min({_d2('p.x', 'ch.x')}) AS key "
                f"FROM {points} p, ({prev}) ch GROUP BY p.id, p.x "
                f"HAVING min({_d2('p.x', 'ch.x')}) > 0) ORDER BY key, id LIMIT 1)")
    allpp = " UNION ALL ".join(f"SELECT cid, x FROM pp{q}" for q in range(1, kmax + 1))
    ctes.append(f"c0 AS MATERIALIZED (SELECT ks.k, CAST(s.cid AS INTEGER) AS cid, s.x AS c "
                f"FROM ks JOIN ({allpp}) s ON s.cid < ks.k)")
    return ctes


def kmeans_sql(points_sql: str, ks: list[int], init: str = "random",
               max_iter: int = KMEANS_MAX_ITER, min_frac: float = KMEANS_MIN_FRAC_REASSIGNED,
               seed: int = 42, output: str = "summary") -> str:
    """Unrolled Lloyd iterations for all K at once. ``points_sql`` yields
    ``(id, x double[])``. ``output``: ``summary`` (``num_clusters, objective_fn,
    frac_reassigned, num_iterations, simple_silhouette``, unrounded) or
    ``centroids`` (``num_clusters, cid, dim, value``)."""
    ctes = [f"pts AS MATERIALIZED (SELECT id, x FROM ({points_sql}) WHERE x IS NOT NULL "
            f"AND list_count(x) = len(x))"]
    ctes += kmeans_seed_ctes("pts", ks, init, seed)
    ctes.append("st0 AS MATERIALIZED (SELECT k, FALSE AS done, 0 AS iters, 1.0 AS frac FROM ks)")
    for t in range(1, max_iter + 1):
        ctes.append(f"dist{t} AS MATERIALIZED (SELECT c.k, p.id, c.cid, {_d2('p.x', 'c.c')} AS d "
                    f"FROM pts p, c{t - 1} c JOIN st{t - 1} s ON s.k = c.k WHERE NOT s.done)")
        ctes.append(f"a{t} AS MATERIALIZED (SELECT k, id, first(cid ORDER BY d, cid) AS cid "
                    f"FROM dist{t} GROUP BY k, id)")
        ctes.append(f"ud{t} AS MATERIALIZED (SELECT a.k, a.cid, g.i, sum(p.x[g.i]) / count(*) AS v "
                    f"FROM a{t} a JOIN pts p ON p.id = a.id, range(1, len(p.x) + 1) g(i) "
                    f"GROUP BY a.k, a.cid, g.i)")
        ctes.append(f"u{t} AS MATERIALIZED (SELECT k, cid, list(v ORDER BY i) AS c FROM ud{t} "
                    f"GROUP BY k, cid)")
        if t == 1:
            ctes.append(f"fr{t} AS MATERIALIZED (SELECT k, 1.0 AS frac FROM ks)")
        else:
            ctes.append(f"fr{t} AS MATERIALIZED (SELECT a.k, avg(CASE WHEN a.cid <> b.cid THEN 1.0 "
                        f"ELSE 0.0 END) AS frac FROM a{t} a JOIN a{t - 1} b ON a.k = b.k AND a.id = b.id "
                        f"GROUP BY a.k)")
        ctes.append(f"st{t} AS MATERIALIZED (SELECT s.k, "
                    f"CASE WHEN s.done THEN TRUE ELSE (fr.frac <= {min_frac!r} OR {t} >= {max_iter}) END AS done, "
                    f"CASE WHEN s.done THEN s.iters ELSE {t} END AS iters, "
                    f"CASE WHEN s.done THEN s.frac ELSE fr.frac END AS frac "
                    f"FROM st{t - 1} s LEFT JOIN fr{t} fr ON fr.k = s.k)")
        ctes.append(f"c{t} AS MATERIALIZED (SELECT c.k, c.cid, CASE WHEN s.done OR u.c IS NULL "
                    f"THEN c.c ELSE u.c END AS c FROM c{t - 1} c JOIN st{t - 1} s ON s.k = c.k "
                    f"LEFT JOIN u{t} u ON u.k = c.k AND u.cid = c.cid)")
    last = max_iter
    if output == "centroids":
        return ("WITH " + ",\n".join(ctes) +
                f"\nSELECT k AS num_clusters, cid, CAST(g.i AS BIGINT) AS dim, c[g.i] AS value "
                f"FROM c{last}, range(1, len(c) + 1) g(i)")
    ctes.append(f"fd AS MATERIALIZED (SELECT c.k, p.id, list_sort(list({_d2('p.x', 'c.c')})) AS ds "
                f"FROM pts p, c{last} c GROUP BY c.k, p.id)")
    return ("WITH " + ",\n".join(ctes) + f"""
    SELECT s.k AS num_clusters, sc.obj AS objective_fn, s.frac AS frac_reassigned,
           s.iters AS num_iterations, sc.sil AS simple_silhouette
    FROM st{last} s JOIN (SELECT k, sum(ds[1]) AS obj,
        avg(CASE WHEN len(ds) < 2 THEN NULL WHEN ds[2] = 0 THEN 0.0
                 ELSE (ds[2] - ds[1]) / ds[2] END) AS sil FROM fd GROUP BY k) sc ON sc.k = s.k""")
