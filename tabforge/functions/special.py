"""Closed-form p-values for the handful of statistics a report ends with.

These run on result tables of one row per feature, after the distributed
aggregation; nothing here sees data rows.
"""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def correlation_p(r: float | None, n: int) -> float | None:
    """Two-sided p of a correlation under t with n-2 degrees of freedom."""
    if r is None or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    df = n - 2.0
    t2 = r * r * df / (1.0 - r * r)
    return incomplete_beta(df / 2.0, 0.5, df / (df + t2))


def kolmogorov_p(d: float | None, n1: int, n2: int) -> float | None:
    """Asymptotic two-sided p of the two-sample KS distance."""
    if d is None or n1 == 0 or n2 == 0:
        return None
    x = math.sqrt(n1 * n2 / (n1 + n2)) * d
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (j - 1) * math.exp(-2.0 * j * j * x * x) for j in range(1, 101))
    return min(1.0, max(0.0, 2.0 * total))
