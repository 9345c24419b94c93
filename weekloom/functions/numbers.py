"""Sums, averages and ratios that do not depend on partition order or fail on zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(c: Column) -> Column:
    """Sum in the column's own type (exact for decimals), then a double."""
    return F.sum(c).cast("double")


def average(c: Column) -> Column:
    return F.try_divide(total(c), F.count(c))


def ratio(numerator: Column, denominator: Column, eps: float = 0.0) -> Column:
    """Null instead of an error when the divisor is zero."""
    return F.try_divide(numerator, denominator + F.lit(eps) if eps else denominator)
