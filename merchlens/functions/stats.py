"""Experiment statistics as column expressions over already aggregated rows."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchlens.functions.scalar import safe_divide


#: Terms of the power series below ``SPLIT`` and of the continued fraction from there on.
SPLIT, SERIES, FRACTION = 2.0, 45, 80


def erfc(x: Column) -> Column:
    """Complementary error function of a number that is not negative, to about 14 digits; null for null."""
    terms = lambda n: F.sequence(F.lit(n), F.lit(1), F.lit(-1))
    bell = F.exp(-x * x)
    series = F.aggregate(terms(SERIES), F.lit(1.0), lambda rest, n: 1.0 + rest * (2.0 * x * x / (2.0 * n + 1.0)))
    fraction = F.aggregate(terms(FRACTION), F.lit(0.0), lambda rest, n: (n / 2.0) / (x + rest))
    near = 1.0 - 2.0 / math.sqrt(math.pi) * x * bell * series
    return F.when(x < SPLIT, near).otherwise(bell / math.sqrt(math.pi) / (x + fraction))


def two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z) / math.sqrt(2.0))


def chi_square_p(chi2: Column) -> Column:
    """Upper tail with one degree of freedom."""
    return erfc(F.sqrt(chi2 / 2.0))


def z_critical(alpha: float) -> float:
    return NormalDist().inv_cdf(1.0 - alpha / 2.0)


def chi_square(observed: list[Column], expected: list[Column]) -> Column:
    parts = [safe_divide((o - e) * (o - e), e) for o, e in zip(observed, expected)]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def pooled_se(x_c: Column, n_c: Column, x_t: Column, n_t: Column) -> Column:
    pooled = safe_divide(x_c + x_t, n_c + n_t)
    return F.sqrt(pooled * (1.0 - pooled) * (safe_divide(F.lit(1.0), n_c) + safe_divide(F.lit(1.0), n_t)))


def unpooled_se(p_c: Column, n_c: Column, p_t: Column, n_t: Column) -> Column:
    return F.sqrt(safe_divide(p_c * (1.0 - p_c), n_c) + safe_divide(p_t * (1.0 - p_t), n_t))
