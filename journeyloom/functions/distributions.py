"""Tail probabilities for the handful of statistics the experiment reports end in.

Spark reduces the data to a few moments; only the last step, on those few numbers,
happens here. Normal quantiles come from the standard library.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np

_NORMAL = NormalDist()


def normal_quantile(p: float) -> float:
    return _NORMAL.inv_cdf(p)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_share(1.0 - x, b, a)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300

    def term(m: int) -> float:
        half = m // 2
        if m % 2 == 0:
            return half * (b - half) * x / ((a + m - 1) * (a + m))
        return -(a + half) * (a + b + half) * x / ((a + m - 1) * (a + m))

    value, c, d = 1.0, 1.0, 0.0
    for m in range(1, 1_000_000):
        step = term(m)
        d = 1.0 / ((1.0 + step * d) or tiny)
        c = (1.0 + step / c) or tiny
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front / (a * value)


def t_two_sided(t: float, df: float) -> float:
    if df > 1e7:
        return normal_two_sided(t)
    return beta_share(df / (df + t * t), df / 2.0, 0.5)


def f_tail(f: float, df1: float, df2: float) -> float:
    if f <= 0:
        return 1.0
    if df2 > 1e7:
        return chi2_tail(f * df1, int(df1))
    return beta_share(df2 / (df2 + df1 * f), df2 / 2.0, df1 / 2.0)


def chi2_tail(x: float, df: int) -> float:
    """Upper tail for a whole number of degrees of freedom, by recurrence."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    tail, k = (math.erfc(math.sqrt(half)), 1) if df % 2 else (math.exp(-half), 2)
    while k < df:
        tail += math.exp((k / 2.0) * math.log(half) - half - math.lgamma(k / 2.0 + 1.0))
        k += 2
    return tail


_STEP, _EDGE, _WIDEST = 0.005, 8.5, 25.0


@lru_cache(maxsize=16)
def _range_table(groups: int) -> tuple[np.ndarray, np.ndarray]:
    """P(range of `groups` standard normals <= q) on a grid of q.

    q moves in grid steps, so the distribution function at z + q is a shifted slice.
    """
    z = np.arange(-_EDGE, _EDGE + _WIDEST + _STEP, _STEP)
    below = np.array([0.5 * math.erfc(-float(v) / math.sqrt(2.0)) for v in z])
    inner = int(round(2 * _EDGE / _STEP)) + 1
    density = np.exp(-0.5 * z[:inner] ** 2) / math.sqrt(2 * math.pi)
    q = np.arange(0.0, _WIDEST, _STEP)
    values = [
        groups * _STEP * float(np.sum(density * (below[k : k + inner] - below[:inner]) ** (groups - 1)))
        for k in range(len(q))
    ]
    return q, np.minimum(values, 1.0)


def _range_cdf(q, groups: int):
    grid, values = _range_table(groups)
    return np.interp(q, grid, values)


def studentized_range_tail(q: float, groups: int, df: float) -> float:
    """P(Q > q) for the studentised range of `groups` means with `df` error degrees."""
    if q <= 0:
        return 1.0
    if df > 20_000:
        return max(0.0, 1.0 - float(_range_cdf(q, groups)))
    spread = 9.0 / math.sqrt(2.0 * df)
    s = np.linspace(max(1e-6, 1.0 - spread), 1.0 + 1.5 * spread, 241)
    log_density = (
        math.log(2.0)
        + (df / 2.0) * math.log(df / 2.0)
        - math.lgamma(df / 2.0)
        + (df - 1.0) * np.log(s)
        - df * s * s / 2.0
    )
    inner = _range_cdf(q * s, groups)
    return float(max(0.0, 1.0 - np.trapezoid(np.exp(log_density) * inner, s)))


def studentized_range_critical(alpha: float, groups: int, df: float) -> float:
    low, high = 0.0, 100.0
    for _ in range(40):
        mid = (low + high) / 2.0
        if studentized_range_tail(mid, groups, df) > alpha:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0
