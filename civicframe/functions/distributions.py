"""Tail probabilities and quantiles for tables of estimates (already aggregated rows)."""

from __future__ import annotations

import math
from statistics import NormalDist


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 400):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return out


def student_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) with df degrees of freedom."""
    if df <= 0 or math.isnan(t):
        return math.nan
    if math.isinf(t):
        return 0.0
    x, a, b = df / (df + t * t), df / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b
