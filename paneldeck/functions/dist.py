"""Distribution functions (ST12): Student-t and normal CDF / quantile.

Vectorised numpy code (regularised incomplete beta by continued fraction).
It only ever runs on small result frames: coefficient rows, per-subject slope
rows, or inside Arrow-batched pandas UDFs.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def _lg(x):
    return _lgamma(np.asarray(x, dtype=float)).astype(float)


def _lentz(term, shape, limit: int = 20_000):
    """1 / (1 + term(1) / (1 + term(2) / (1 + ...))) element-wise by the modified
    Lentz method; NaN where it has not settled after ``limit`` terms."""
    floor = 1e-300
    guard = lambda v: np.where(np.abs(v) < floor, floor, v)
    upper, lower, value = np.ones(shape), np.zeros(shape), np.ones(shape)
    settled = np.zeros(shape, dtype=bool)
    for k in range(1, limit + 1):
        d = term(k)
        lower = 1.0 / guard(1.0 + d * lower)
        upper = guard(1.0 + d / upper)
        step = upper * lower
        value = np.where(settled, value, value * step)
        settled |= np.abs(step - 1.0) < 3e-16
        if settled.all():
            break
    return np.where(settled, 1.0 / value, np.nan)


def _beta_fraction(a, b, x):
    """Continued fraction of the incomplete beta function (DLMF 8.17.22)."""
    def term(k):
        m, odd = divmod(k, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
    return _lentz(term, np.shape(x))


def _lgamma_step(a, b):
    """lgamma(a + b) - lgamma(a) without cancellation.  From a = 100 on it is the
    difference of two Stirling series, whose first dropped term is under 6e-18."""
    def series(z):
        return 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    big = np.maximum(a, 100.0)
    far = (big - 0.5) * np.log1p(b / big) + b * np.log(big + b) - b + series(big + b) - series(big)
    return np.where(a >= 100.0, far, _lg(a + b) - _lg(a))


def _beta_part(a, b, x, y):
    """I_x(a, b) for 0 < x < 1 with y = 1 - x given to full relative precision."""
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q = np.where(swap, b, a), np.where(swap, a, b)
    u, v = np.where(swap, y, x), np.where(swap, x, y)
    log_u = np.where(u > 0.5, np.log1p(-np.minimum(v, 0.5)), np.log(np.maximum(u, 1e-320)))
    log_v = np.where(v > 0.5, np.log1p(-np.minimum(u, 0.5)), np.log(np.maximum(v, 1e-320)))
    # 1 / B(p, q) from the larger parameter, so the step never cancels
    large, small = np.maximum(p, q), np.minimum(p, q)
    front = np.exp(_lgamma_step(large, small) - _lg(small) + p * log_u + q * log_v) / p
    part = front * _beta_fraction(p, q, u)
    return np.where(swap, 1.0 - part, part)


def betainc(a, b, x):
    """Regularised incomplete beta I_x(a, b), element-wise."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    inner = ok & (x > 0) & (x < 1)
    if inner.any():
        out[inner] = _beta_part(a[inner], b[inner], x[inner], 1.0 - x[inner])
    return out


# From this many degrees of freedom on the t tail is read off the normal
# distribution through Hill's transformation; its error there is far below
# rounding, while the continued fraction would need ever more terms.  A test
# compares the two on both sides of the limit.
HILL_FROM = 100_000.0


def _hill_two_sided(t, df):
    """2 P(T > |t|) by Hill's normalising transformation (1970)."""
    a = df - 0.5
    b = 48.0 * a * a
    w = np.sqrt(a * np.log1p(t * t / df))
    z = w + (w**3 + 3 * w) / b - (4 * w**7 + 33 * w**5 + 240 * w**3 + 855 * w) / (10 * b * (b + 0.8 * w**4 + 100))
    return norm_two_sided_p(z)


def t_two_sided_p(t, df):
    """Two-sided p-value of Student's t: 2 * P(T > |t|)."""
    t = np.asarray(t, float)
    df = np.asarray(df, float)
    t, df = np.broadcast_arrays(t, df)
    p = np.full(t.shape, np.nan)
    known = np.isfinite(t) & np.isfinite(df) & (df > 0)
    far = known & (df >= HILL_FROM)
    near = known & ~far & (t != 0)
    p[known & (t == 0)] = 1.0
    if far.any():
        p[far] = _hill_two_sided(t[far], df[far])
    if near.any():
        tt, nu = np.minimum(np.abs(t[near]), 1e150) ** 2, df[near]
        with np.errstate(under="ignore"):
            p[near] = _beta_part(nu / 2.0, np.full(nu.shape, 0.5), nu / (nu + tt), tt / (nu + tt))
    p = np.where(np.isinf(t) & (df > 0), 0.0, p)
    return np.where((df > 0) & np.isfinite(df), p, np.nan)


def t_cdf(t, df):
    t = np.asarray(t, float)
    tail = 0.5 * t_two_sided_p(t, df)
    return np.where(t >= 0, 1.0 - tail, tail)


def t_ppf(q, df, iters: int = 200):
    """Quantile of Student's t by bisection on the CDF (monotone, robust).

    Evaluated once per distinct (q, df) pair: a column of per-subject degrees
    of freedom has few distinct values."""
    q, df = np.broadcast_arrays(np.asarray(q, float), np.asarray(df, float))
    if q.size > 1:
        pairs = np.stack([q.ravel(), df.ravel()], axis=1)
        uniq, inv = np.unique(pairs, axis=0, return_inverse=True)
        if len(uniq) < len(pairs):
            return _t_ppf(uniq[:, 0], uniq[:, 1], iters)[inv.ravel()].reshape(q.shape)
    return _t_ppf(q, df, iters)


def _t_ppf(q, df, iters: int = 200):
    q, df = np.broadcast_arrays(np.asarray(q, float), np.asarray(df, float))
    lo, hi = np.full(q.shape, -1.0), np.full(q.shape, 1.0)
    inside = (df > 0) & (q > 0) & (q < 1)
    for _ in range(1100):  # double the bracket until it holds the root
        low, high = inside & (t_cdf(lo, df) > q), inside & (t_cdf(hi, df) < q)
        if not (low.any() or high.any()):
            break
        lo, hi = np.where(low, 2 * lo, lo), np.where(high, 2 * hi, hi)
    for _ in range(iters):
        mid = 0.5 * (lo + hi)
        below = t_cdf(mid, df) < q
        lo = np.where(below, mid, lo)
        hi = np.where(below, hi, mid)
        if np.all(hi - lo <= 1e-13 * np.maximum(1.0, np.abs(mid))):
            break
    out = 0.5 * (lo + hi)
    return np.where((df > 0) & (q > 0) & (q < 1), out, np.nan)


def norm_cdf(z):
    z = np.asarray(z, float)
    return 0.5 * np.vectorize(math.erfc, otypes=[float])(-z / math.sqrt(2.0))


def norm_two_sided_p(z):
    z = np.abs(np.asarray(z, float))
    return np.vectorize(math.erfc, otypes=[float])(z / math.sqrt(2.0))


# --- Arrow-batched column wrappers ------------------------------------------

@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided_p(t.astype(float).to_numpy(), df.astype(float).to_numpy()))


# --- JVM-side quantile column ---------------------------------------------

_T_TABLE_MAX = 1000


def _cornish_fisher(z: float):
    """Coefficients of the Cornish-Fisher expansion of the t quantile in 1/df
    (Abramowitz & Stegun 26.7.5)."""
    g1 = (z ** 3 + z) / 4.0
    g2 = (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96.0
    g3 = (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384.0
    g4 = (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160.0
    return g1, g2, g3, g4


def _norm_ppf(p: float) -> float:
    lo, hi = -40.0, 40.0  # beyond 38.5 a double holds no tail probability
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if 0.5 * math.erfc(-mid / math.sqrt(2.0)) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


@functools.lru_cache(maxsize=16)
def _t_table(q: float) -> tuple:
    return tuple(_t_ppf(np.full(_T_TABLE_MAX, q), np.arange(1, _T_TABLE_MAX + 1, dtype=float)))


def t_quantile_col(q: float, df_col):
    """Student-t quantile of a fixed probability ``q`` for a column of degrees
    of freedom, evaluated inside the JVM (no Python worker): exact values for
    df = 1..1000 are computed once here and embedded as a literal array (a
    table bounded by construction); larger df use the Cornish-Fisher series,
    whose error is O(df^-5).  Non-integer or non-positive df give NULL."""
    table = _t_table(float(q))
    arr = F.array(*[F.lit(float(v)) for v in table])
    z = _norm_ppf(q)
    g1, g2, g3, g4 = _cornish_fisher(z)
    nu = df_col.cast("double")
    series = F.lit(z) + F.lit(g1) / nu + F.lit(g2) / (nu * nu) + F.lit(g3) / (nu * nu * nu) + F.lit(g4) / (nu * nu * nu * nu)
    idx = df_col.cast("int")
    return (F.when(df_col.isNull() | (nu < 1) | (nu != F.floor(nu)), F.lit(None).cast("double"))
            .when(nu <= _T_TABLE_MAX, F.element_at(arr, idx))
            .otherwise(series))
