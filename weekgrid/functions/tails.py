"""Tail probabilities of test statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def _sum(n: Column, term) -> Column:
    """Sum of ``term(i)`` for i from 1 to ``n``."""
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int")), term), F.lit(0.0), lambda s, x: s + x)


def log_gamma_half(df: Column) -> Column:
    """ln of gamma(df / 2 + 1) for a whole number ``df``."""
    odd = df % 2 == 1
    steps = F.floor((df + 1) / 2)
    shift = F.when(odd, 0.5).otherwise(0.0)
    start = F.when(odd, 0.5 * math.log(math.pi)).otherwise(0.0)
    return start + F.when(steps > 0, _sum(steps, lambda i: F.log(i - shift))).otherwise(0.0)


def chi_square_tail(statistic: Column, df: Column) -> Column:
    """P(X >= statistic) of a chi-square variable with ``df`` degrees of freedom, a
    whole number; 1 where ``df`` is 0, 0 for an infinite statistic.

    1 less the series of the lower incomplete gamma function, whose terms fall once
    their number exceeds y - a; so far out that nothing is left of the tail in double
    precision it is 0 without the series.
    """
    a, y = df / 2.0, statistic / 2.0
    first = a * F.log(y) - y - log_gamma_half(df)
    terms = F.ceil(F.greatest(y - a, F.lit(0.0)) + 12 * F.sqrt(y + a) + 60)
    grown = F.aggregate(
        F.sequence(F.lit(1), terms.cast("int")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda s, i: F.struct((s["term"] * y / (a + i)).alias("term"), (s["sum"] + s["term"] * y / (a + i)).alias("sum")),
    )["sum"]
    tail = F.greatest(F.lit(0.0), 1.0 - F.exp(first) * grown)
    return F.when((df <= 0) | (y <= 0), 1.0).when(y > a + 12 * F.sqrt(a) + 60, 0.0).otherwise(tail)


def kolmogorov_tail(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic P(D >= distance) of the two-sample statistic for samples of n and m.

    An alternating series in z = distance * sqrt(n m / (n + m)); below z = 0.2 the
    probability differs from 1 by less than 1e-11.
    """
    z2 = distance * distance * n * m / (n + m)
    total = 2 * _sum(F.lit(100), lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * z2))
    return F.when(z2 < 0.04, 1.0).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))
