"""Closed-form distribution tails evaluated on tiny, already-aggregated results."""

from __future__ import annotations

import math


def _gamma_q(s: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(s, x) (series / continued fraction)."""
    if x < 0 or s <= 0:
        raise ValueError("bad arguments")
    if x == 0:
        return 1.0
    gln = math.lgamma(s)
    if x < s + 1.0:
        term = total = 1.0 / s
        a = s
        for _ in range(10_000):
            a += 1.0
            term *= x / a
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return max(0.0, 1.0 - total * math.exp(-x + s * math.log(x) - gln))
    tiny = 1e-300
    b = x + 1.0 - s
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return math.exp(-x + s * math.log(x) - gln) * h


def chi2_sf(x: float | None, dof: int | None) -> float | None:
    """P(X >= x) for a chi-square variable with ``dof`` degrees of freedom."""
    if x is None or dof is None or dof <= 0 or math.isnan(x):
        return None
    if dof == 1:
        return math.erfc(math.sqrt(x / 2.0))
    if dof == 2:
        return math.exp(-x / 2.0)
    return _gamma_q(dof / 2.0, x / 2.0)
