"""Statistical finalisers that Spark SQL lacks (log-gamma, erfc).

They run on already-aggregated tables (one row per model pair), through
Arrow-batched pandas UDFs.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularized incomplete beta (modified Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    m = 0
    while True:
        m += 1
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            return h
        if m > 100 * (1 + math.sqrt(a + b)):  # it takes about the root of a + b terms
            raise ArithmeticError(f"no convergence for a={a}, b={b}, x={x}")


def binom_cdf_half(k: int, n: int) -> float:
    """P(X <= k) for X ~ Binomial(n, 1/2)."""
    if n <= 0 or k >= n:
        return 1.0
    if k < 0:
        return 0.0
    # I_{1/2}(n-k, k+1) via the continued fraction
    a, b, x = float(n - k), float(k + 1), 0.5
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def mcnemar_exact_p(b: int, c: int) -> float:
    return min(1.0, 2.0 * binom_cdf_half(min(b, c), b + c))


def mcnemar_chi2(b: int, c: int) -> tuple[float, float]:
    n = b + c
    if n == 0:
        return float("nan"), float("nan")
    stat = (abs(b - c) - 1.0) ** 2 / n
    return stat, math.erfc(math.sqrt(stat / 2.0))


@F.pandas_udf(T.DoubleType())
def mcnemar_exact_p_udf(b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series([mcnemar_exact_p(int(x), int(y)) for x, y in zip(b, c)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_sf1_udf(stat: pd.Series) -> pd.Series:
    """Survival function of chi-square with one degree of freedom."""
    return stat.map(lambda s: math.erfc(math.sqrt(s / 2.0)) if s == s else float("nan")).astype("float64")
