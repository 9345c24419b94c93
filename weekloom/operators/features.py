"""Lag, rolling, trend, calendar and interaction features of a series.

A series has one row per group and date, as the aggregates produce it, so a group
is no longer than the calendar. All windows share one partitioning and order and
so one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.columns import RETAIL
from weekloom.functions.dates import as_date, date_parts
from weekloom.functions.numbers import ratio
from weekloom.operators.schema import quoted, require_columns
from weekloom.operators.spine import ensure_continuity

LAGS = (1, 2, 4)
WINDOWS = (1, 2, 4)
ADD_ALL_WINDOWS = (2, 4)


def _series(group: str, date: str):
    """Rows without a date come last, where they are no other row's past."""
    return Window.partitionBy(quoted(group)).orderBy(F.col(quoted(date)).asc_nulls_last())


def add_date_parts(df: DataFrame, date: str = RETAIL.week) -> DataFrame:
    day = as_date(F.col(quoted(date)), df.schema[date].dataType)
    return df.withColumn(date, day).withColumns(date_parts(F.col(quoted(date))))


def add_lag_features(
    df: DataFrame, group: str, target: str, lags: Sequence[int] = LAGS, date: str = RETAIL.week
) -> DataFrame:
    """Value ``n`` rows earlier in the group."""
    series = _series(group, date)
    return df.withColumns({f"{target}_lag{n}": F.lag(quoted(target), n).over(series) for n in lags})


def _before(group: str, date: str, width: int):
    return _series(group, date).rowsBetween(-width, -1)


def add_rolling_means(
    df: DataFrame, group: str, target: str, windows: Sequence[int] = WINDOWS, date: str = RETAIL.week
) -> DataFrame:
    """Mean of up to ``w`` rows before the current one; null on the first."""
    return df.withColumns(
        {f"{target}_rollmean{w}": F.avg(quoted(target)).over(_before(group, date, w)) for w in windows}
    )


def add_rolling_stddevs(
    df: DataFrame, group: str, target: str, windows: Sequence[int] = WINDOWS, date: str = RETAIL.week
) -> DataFrame:
    """Sample standard deviation over the same rows; null for a single value."""
    return df.withColumns(
        {
            f"{target}_rollstd{w}": F.stddev_samp(quoted(target)).over(_before(group, date, w))
            for w in windows
        }
    )


def add_rolling_features(
    df: DataFrame, group: str, target: str, windows: Sequence[int] = WINDOWS, date: str = RETAIL.week
) -> DataFrame:
    for w in windows:
        df = add_rolling_means(df, group, target, [w], date)
        df = add_rolling_stddevs(df, group, target, [w], date)
    return df


def add_trend_features(
    df: DataFrame, target: str, lag1: int = 1, lag2: int = 2, eps: float = 0.0
) -> DataFrame:
    """Difference and ratio of two lags. ``eps`` is added to the divisor."""
    names = [f"{target}_lag{lag1}", f"{target}_lag{lag2}"]
    require_columns(df, names)
    near, far = (F.col(quoted(name)) for name in names)
    return df.withColumns(
        {
            f"{target}_lag_diff{lag1}_{lag2}": near - far,
            f"{target}_lag_ratio{lag1}_{lag2}": ratio(near, far, eps),
        }
    )


def add_interaction_features(df: DataFrame, target: str) -> DataFrame:
    """Previous value times week of year and times month."""
    require_columns(df, [f"{target}_lag1", "week_of_year", "month"])
    previous = F.col(quoted(f"{target}_lag1"))
    return df.withColumns(
        {
            f"{target}_lag1_x_week_of_year": previous * F.col("week_of_year"),
            f"{target}_lag1_x_month": previous * F.col("month"),
        }
    )


def run_all(
    df: DataFrame,
    group: str,
    target: str,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    date: str = RETAIL.week,
    densify: bool = False,
    grain: str = "week",
) -> DataFrame:
    """Calendar, lag, rolling and trend features.

    Lags count rows. ``densify`` adds the missing periods of ``grain`` first, so that
    one row earlier is also one period earlier.
    """
    if densify:
        df = ensure_continuity(df, date, [group], grain)
    return (
        df.transform(add_date_parts, date)
        .transform(add_lag_features, group, target, lags, date)
        .transform(add_rolling_features, group, target, windows, date)
        .transform(add_trend_features, target)
    )


def add_all(
    df: DataFrame,
    group: str,
    target: str,
    date: str = RETAIL.week,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ADD_ALL_WINDOWS,
) -> DataFrame:
    """As ``run_all``, with the trend of the first two lags, and interactions."""
    return (
        df.transform(add_date_parts, date)
        .transform(add_lag_features, group, target, lags, date)
        .transform(add_rolling_features, group, target, windows, date)
        .transform(add_trend_features, target, lags[0], lags[1])
        .transform(add_interaction_features, target)
    )
