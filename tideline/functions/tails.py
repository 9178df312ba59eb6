"""Tail probabilities for test statistics, evaluated on a handful of result rows."""
from __future__ import annotations

import math

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    small = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > small else small)
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > small else small)
            c = 1.0 + num / c
            c = c if abs(c) > small else small
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def student_two_sided(r: float, n: float) -> float:
    """Two-sided p of a correlation ``r`` over ``n`` pairs."""
    if r is None or math.isnan(r) or n is None or n < 3:
        return math.nan
    if abs(r) >= 1.0:
        return 0.0
    df = n - 2.0
    t2 = r * r * df / (1.0 - r * r)
    return incomplete_beta(df / 2.0, 0.5, df / (df + t2))


def normal_two_sided(z: float) -> float:
    if z is None or math.isnan(z):
        return math.nan
    return min(1.0, math.erfc(z / math.sqrt(2.0)))


@pandas_udf(DoubleType())
def correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([student_two_sided(a, b) for a, b in zip(r, n)], dtype="float64")


@pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(a) for a in z], dtype="float64")
