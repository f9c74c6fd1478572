"""Two-sided p-value of Student's t, for the handful of rows a comparison report has."""

from __future__ import annotations

import math

_TINY = 1e-300


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated forwards (modified Lentz)."""
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    value = d
    for m in range(1, 1000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        factor = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = 1.0 + term / c
            c = c if abs(c) > _TINY else _TINY
            factor = c * d
            value *= factor
        if abs(factor - 1.0) < 1e-15:
            break
    return value


def regularised_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return scale * _beta_fraction(a, b, x) / a
    return 1.0 - scale * _beta_fraction(b, a, 1.0 - x) / b


def two_sided_p(t: float | None, df: float | None) -> float | None:
    if t is None or df is None or not df > 0:
        return None
    return regularised_beta(df / 2.0, 0.5, df / (df + t * t))
