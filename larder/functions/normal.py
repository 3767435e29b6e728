"""The normal distribution in column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from larder.functions.numbers import let

_ROOT_2PI = math.sqrt(2 * math.pi)
#: Terms of the series; beyond ``_MIDDLE`` the continued fraction takes over.
_TERMS, _MIDDLE, _DEPTH = 60, 3.5, 40
_STEPS = 3


def normal_density(x: Column) -> Column:
    return F.exp(-x * x / 2) / _ROOT_2PI


def _middle_cdf(x: Column) -> Column:
    """1/2 + density * (x + x^3/3 + x^5/15 + ...), by Horner's rule."""
    terms = F.sequence(F.lit(_TERMS), F.lit(1), F.lit(-1))
    total = F.aggregate(terms, F.lit(1.0), lambda rest, k: 1 + x * x / (2 * k + 1) * rest)
    return 0.5 + normal_density(x) * x * total


def _tail(x: Column) -> Column:
    """The upper tail of a large positive ``x``: density / (x + 1/(x + 2/(x + ...)))."""
    return normal_density(x) / F.aggregate(F.sequence(F.lit(_DEPTH), F.lit(1), F.lit(-1)), x, lambda rest, k: x + k / rest)


def normal_cdf(x: Column) -> Column:
    """The standard normal distribution function; null for null."""
    return let(x, lambda v: F.when(v > _MIDDLE, 1 - _tail(v)).when(v < -_MIDDLE, _tail(-v)).otherwise(_middle_cdf(v)))


def _lower_tail(x: Column) -> Column:
    """The distribution function of x <= 0, where it keeps its relative precision."""
    return F.when(x < -_MIDDLE, _tail(-x)).otherwise(_middle_cdf(x))


def normal_quantile(p: Column) -> Column:
    """The value that a standard normal variable stays below with probability ``p``.

    A rational start is good to 5e-4; Newton steps on the logarithm of the smaller tail
    make it right to about 1e-14. Null unless 0 < p < 1.
    """

    def start(t: Column) -> Column:
        # The rational approximation 26.2.23 of Abramowitz and Stegun.
        return t - (2.515517 + t * (0.802853 + t * 0.010328)) / (1 + t * (1.432788 + t * (0.189269 + t * 0.001308)))

    def refined(q: Column) -> Column:
        """The quantile of a tail q <= 1/2, at most 0."""
        value = -let(F.sqrt(-2 * F.log(q)), start)
        for _ in range(_STEPS):
            value = let(value, lambda z: let(
                _lower_tail(z), lambda tail: F.least(z - F.log(tail / q) * tail / normal_density(z), F.lit(0.0))))
        return value

    return F.when((p > 0) & (p < 1), F.when(p <= 0.5, refined(F.least(p, F.lit(0.5)))).otherwise(-refined(F.least(1 - p, F.lit(0.5)))))
