"""Exact tests and intervals on counts, as Spark columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.959963984540054


def wilson(k: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Lower and upper bound of a share k of n."""
    p = k / n
    mid = p + z * z / (2 * n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (mid - half) / (1 + z * z / n), (mid + half) / (1 + z * z / n)


def log_factorial(n: Column) -> Column:
    """ln n!: a sum for small n, Stirling's series (to 1e-12) beyond, so large counts cost nothing."""
    small = F.aggregate(F.sequence(F.lit(1), F.least(n, F.lit(64)).cast("int")), F.lit(0.0), lambda a, x: a + F.ln(x))
    x = n.cast("double")
    series = x * F.ln(x) - x + 0.5 * F.ln(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n > 64, series).when(n > 1, small).otherwise(0.0)


def _log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def fisher(a: Column, n1: Column, b: Column, n2: Column) -> Column:
    """Two-sided exact p of a of n1 against b of n2: all tables at most as likely as the one seen."""
    k = a + b
    lo, hi = F.greatest(F.lit(0), k - n2), F.least(n1, k)
    total = _log_choose(n1 + n2, k)
    prob = lambda x: F.exp(_log_choose(n1, x) + _log_choose(n2, k - x) - total)
    seen = prob(a)
    return F.aggregate(F.sequence(lo.cast("int"), hi.cast("int")), F.lit(0.0), lambda acc, x: acc + F.when(prob(x) <= seen * (1 + 1e-7), prob(x)).otherwise(0.0))


def binomial_two_sided(k: Column, n: Column) -> Column:
    """Exact two-sided p of k successes in n even trials (sign test; McNemar on the discordant pairs). 1 without trials."""
    low = F.least(k, n - k)
    tail = F.aggregate(F.sequence(F.lit(0), low.cast("int")), F.lit(0.0), lambda a, x: a + F.exp(_log_choose(n, x) - n * F.ln(F.lit(2.0))))
    return F.when(n > 0, F.least(F.lit(1.0), 2 * tail)).otherwise(1.0)


def kappa(both: Column, only_a: Column, only_b: Column, neither: Column) -> Column:
    n = both + only_a + only_b + neither
    seen = (both + neither) / n
    chance = ((both + only_a) * (both + only_b) + (neither + only_b) * (neither + only_a)) / (n * n)
    return F.when(chance < 1, (seen - chance) / (1 - chance))


def escalate(k: Column, n: Column, least: int = 4, threshold: float = 0.0395) -> Column:
    """Enough hits, and a lower bound of the share that reaches the threshold."""
    return (k >= least) & (wilson(k, n)[0] >= threshold)
