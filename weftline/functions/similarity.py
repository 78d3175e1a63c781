"""Similarity measures of two items as column expressions over pair statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Differences below this share of their terms are rounding, not values.
ROUNDING = 1e-12


def squared_distance(sq_a: Column, sq_b: Column, dot: Column) -> Column:
    """``|a|² + |b|² - 2 a·b``; 0 where only rounding is left, so equal vectors are at distance 0."""
    both = sq_a + sq_b
    left = both - 2 * dot
    return F.when(left <= both * ROUNDING, F.lit(0.0)).otherwise(left)


def variance_term(n: Column, total: Column, squares: Column) -> Column:
    """``n Σx² - (Σx)²``; 0 where only rounding is left, so a constant side has none."""
    left = n * squares - total * total
    return F.when(left <= n * squares * ROUNDING, F.lit(0.0)).otherwise(left)


def cooccurrence(n_both: Column, n_a: Column, n_b: Column) -> Column:
    return n_both / F.sqrt(n_a.cast("double") * n_b.cast("double"))


def correlation(n: Column, dot: Column, sum_a: Column, sum_b: Column, sq_a: Column, sq_b: Column) -> Column:
    """Pearson correlation over co-raters; NULL where one side is constant."""
    spread = F.sqrt(variance_term(n, sum_a, sq_a)) * F.sqrt(variance_term(n, sum_b, sq_b))
    return F.try_divide(n * dot - sum_a * sum_b, spread)


def regularized_correlation(
    n: Column, plain: Column, virtual_count: float, prior: float
) -> Column:
    """Correlation pulled to ``prior`` as if ``virtual_count`` pairs had it."""
    weight = n / (n + F.lit(virtual_count))
    return weight * plain + (1 - weight) * F.lit(prior)


def cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    return F.try_divide(dot, norm_a * norm_b)


def damped_cosine(
    dot: Column, norm_a: Column, norm_b: Column, n_both: Column, n_a: Column, n_b: Column
) -> Column:
    """Cosine damped by the raters of both sides; not symmetric in a and b."""
    return F.try_divide(dot * n_both, norm_a * norm_b * n_a * F.log10(n_b + F.lit(10)))


def jaccard(n_both: Column, n_a: Column, n_b: Column) -> Column:
    return n_both / (n_a + n_b - n_both)
