"""Small dense solves on p x p sufficient statistics (NumPy only).

Regressions use Goodnight's SWEEP operator on a cross-product matrix. A pivot
whose remaining diagonal is at most ``TOL`` times its original value is
linearly dependent on the pivots already swept and is skipped (coefficient 0),
so rank-deficient inputs give a defined answer. The oracle SQL performs the
same sweeps, so both engines agree to rounding.
"""

from __future__ import annotations

import numpy as np

from sparkprep.constants import VIF_PERFECT_FIT

# Our numerical choices: pivot tolerance and the perfect-fit ratio.
TOL = 1e-10
PERFECT_FIT = 1e-12
VIF_SENTINEL = VIF_PERFECT_FIT


def sweep(a: np.ndarray, k: int) -> None:
    """Sweep ``a`` on pivot ``k`` in place."""
    d = a[k, k]
    row = a[k, :].copy()
    col = a[:, k].copy()
    a -= np.outer(col, row) / d
    a[k, :] = row / d
    a[:, k] = col / d
    a[k, k] = -1.0 / d


def sweep_pivots(a: np.ndarray, pivots, tol: float = TOL) -> tuple[np.ndarray, list[int]]:
    """Sweep ``pivots`` in order; returns the swept copy and the pivots used."""
    a = np.array(a, dtype=np.float64, copy=True)
    d0 = np.diag(a).copy()
    used = []
    for k in pivots:
        if d0[k] > 0 and a[k, k] > tol * d0[k]:
            sweep(a, k)
            used.append(k)
    return a, used


def regress(cp: np.ndarray, target: int, features: list[int]) -> tuple[np.ndarray, float]:
    """Coefficients and residual sum of squares of ``target`` on ``features``
    from a cross-product matrix ``cp`` (raw for no intercept, centred for one)."""
    a, used = sweep_pivots(cp, features)
    coef = np.array([a[k, target] if k in used else 0.0 for k in features])
    return coef, float(a[target, target])


#: A pivot this many times above or below the tolerance is clearly kept or clearly dependent.
CLEAR = 1e3


def all_residuals(cp: np.ndarray) -> np.ndarray | None:
    """Residual sum of squares of every variable on all others, dependent columns included.

    One Cholesky factorisation with pivoting finds a set of independent columns and writes each
    other column as a combination of them. A column that is such a combination, or that one of
    them needs, is explained perfectly (0); any other is explained by the independent columns
    only, and its residual is read off their inverse. None where a pivot or a weight lies near
    the tolerance, so that the order of sweeps would matter.
    """
    p = len(cp)
    d0 = np.diag(cp).astype(np.float64)
    live = np.flatnonzero(d0 > 0)  # an all-zero column explains nothing
    out = np.zeros(p)
    scale = np.sqrt(d0[live])
    g = cp[np.ix_(live, live)] / np.outer(scale, scale)
    n = len(live)
    left, order, factor = g.copy(), np.arange(n), np.zeros((n, n))
    rank = 0
    while rank < n:
        k = int(np.argmax(np.diag(left)[order[rank:]])) + rank
        order[[rank, k]] = order[[k, rank]]
        at = order[rank]
        pivot = left[at, at]
        if pivot <= TOL * CLEAR:
            if pivot > TOL / CLEAR:
                return None
            break
        column = left[:, at] / np.sqrt(pivot)
        factor[:, rank] = column
        left -= np.outer(column, column)
        rank += 1
    own, rest = order[:rank], order[rank:]
    inverse = np.linalg.inv(g[np.ix_(own, own)])
    residual = 1.0 / np.diag(inverse)
    if (residual <= TOL * CLEAR).any():
        return None
    if len(rest):
        weights = inverse @ g[np.ix_(own, rest)]
        # what a dependent column adds beyond the independent ones without this column
        adds = (weights ** 2 * residual[:, None]).max(axis=1)
        if ((adds > TOL / CLEAR) & (adds < TOL * CLEAR)).any():
            return None
        residual = np.where(adds >= TOL * CLEAR, 0.0, residual)
    out[live[own]] = residual * d0[live[own]]
    return out


def ridge(n: float, means: np.ndarray, cov_pop: np.ndarray, alpha: float):
    """Ridge with an unpenalised intercept. ``means``/``cov_pop`` cover the p
    features followed by the label. Returns (coef, intercept, r_square)."""
    p = len(means) - 1
    c = n * cov_pop
    a = c.copy()
    a[np.arange(p), np.arange(p)] += alpha
    s, used = sweep_pivots(a, range(p))
    w = np.array([s[k, p] if k in used else 0.0 for k in range(p)])
    xx, xy, yy = c[:p, :p], c[:p, p], c[p, p]
    rss = yy - 2.0 * w @ xy + w @ xx @ w
    r2 = 1.0 - rss / yy if yy > 0 else float("nan")
    intercept = means[p] - means[:p] @ w
    return w, float(intercept), float(r2)
