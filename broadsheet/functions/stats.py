"""Student-t tail for the few aggregated rows of a trend."""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from the tail."""
    value = 0.0
    for m in range(300, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = even / (1.0 + odd / (1.0 + value))
    first = -(a + b) * x / (a + 1)
    return 1.0 / (1.0 + first / (1.0 + value))


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return scale * _beta_fraction(a, b, x) / a
    return 1.0 - scale * _beta_fraction(b, a, 1.0 - x) / b


def student_two_sided(t: float | None, dof: float) -> float | None:
    if t is None or t != t or dof <= 0:
        return None
    return regularized_beta(dof / 2, 0.5, dof / (dof + t * t))
