"""Guarded ratios and conditional aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """Quotient times ``scale``; 0 where the denominator is 0, NULL where either is NULL."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d * F.lit(scale))


def ratio_or_null(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """Quotient times ``scale``; NULL where the denominator is 0 or either is NULL."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when(d != 0, n / d * F.lit(scale))


def sum_when(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over matching rows; other rows add 0."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_when(condition: Column) -> Column:
    """Number of matching rows; an unknown condition does not match."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def any_when(condition: Column) -> Column:
    """1 if some row matches, else 0."""
    return F.max(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def mean_of(total: Column, n: Column) -> Column:
    """Mean from an exact total and a count of non-NULL values; NULL for no values."""
    return ratio_or_null(total, n)
