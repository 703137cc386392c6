"""Tail probabilities for small result tables (a handful of scalars per call)."""

from __future__ import annotations

import math
from statistics import NormalDist

_STANDARD = NormalDist()
_TINY = 1e-300


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def norm_ppf(p: float) -> float:
    return _STANDARD.inv_cdf(p)


def _continued_beta(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    result = d
    for m in range(1, 2000):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = 1.0 + top / c
            c = c if abs(c) > _TINY else _TINY
            result *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return result


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _continued_beta(a, b, x) / a
    return 1.0 - front * _continued_beta(b, a, 1 - x) / b


def gamma_sf(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1.0 - front * total
    b = x + 1 - a
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = step * d + b
        d = 1 / (d if abs(d) > _TINY else _TINY)
        c = b + step / c
        c = c if abs(c) > _TINY else _TINY
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h


def chi2_sf(x: float, df: float) -> float:
    return float(gamma_sf(df / 2, float(x) / 2))


def f_sf(x: float, d1: float, d2: float) -> float:
    if not x > 0:
        return 1.0
    return float(beta_inc(d2 / 2, d1 / 2, float(d2 / (d2 + d1 * x))))


def t_two_sided(t: float, df: float) -> float:
    return float(beta_inc(df / 2, 0.5, float(df / (df + t * t))))
