"""Tail probabilities for the one result row of a hypothesis test."""

from __future__ import annotations

import math

_TINY = 1e-300
_STEPS = 10_000


def _lentz(terms) -> float:
    """Continued fraction 1/(1+ a1/(1+ a2/(1+ ...))) by the modified Lentz method."""
    value, c, d = 1.0, 1.0, 0.0
    for numerator in terms:
        d = 1.0 + numerator * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + numerator / c
        c = c if abs(c) > _TINY else _TINY
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return 1.0 / value


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - regularized_beta(b, a, 1.0 - x)

    def terms():
        for m in range(_STEPS):
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            k = m + 1
            yield k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))

    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    log_front += a * math.log(x) + b * math.log1p(-x)
    return math.exp(log_front) * _lentz(terms()) / a


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| >= |t|) of Student's t with ``dof`` degrees of freedom."""
    return regularized_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def chi_square_tail(x: float, dof: float) -> float:
    """P(X >= x) of the chi-square distribution: upper regularised gamma."""
    a, z = dof / 2.0, x / 2.0
    if z <= 0.0:
        return 1.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1.0:
        term = total = 1.0 / a
        for n in range(1, _STEPS):
            term *= z / (a + n)
            total += term
            if term < total * 1e-16:
                break
        return max(0.0, 1.0 - front * total)
    c, d = math.inf, 1.0 / (z + 1.0 - a)
    h = d
    for n in range(1, _STEPS):
        an = -n * (n - a)
        bn = z + 1.0 - a + 2.0 * n
        d = 1.0 / (an * d + bn)
        c = bn + an / c
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * h
