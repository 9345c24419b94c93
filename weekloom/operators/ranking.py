"""First rows and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.columns import RETAIL
from weekloom.operators.schema import quoted


def head(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows of an order; each task keeps only ``n``."""
    return df.orderBy(*order_by).limit(n)


def random_sample(df: DataFrame, n: int = 10, seed: int | None = None) -> DataFrame:
    """``n`` random rows; a seed makes the choice repeatable on the same files."""
    return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(n)


def first_dates(df: DataFrame, date: str = RETAIL.date, n: int = 5) -> DataFrame:
    """The earliest dates, as a glance; ``missing_periods`` finds the gaps."""
    return head(df.select(quoted(date)), [quoted(date)], n)
