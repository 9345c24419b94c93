"""Sales by day, week or month and key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.columns import RETAIL, SalesColumns
from weekloom.functions.dates import as_date, period_start
from weekloom.functions.numbers import average, total
from weekloom.operators.schema import quoted
from weekloom.shared import materialise


def add_period(
    df: DataFrame, date: str = RETAIL.date, grain: str = "week", period: str = RETAIL.week
) -> DataFrame:
    """Turn the date (or its text) into a date and add the start of its period."""
    day = as_date(F.col(quoted(date)), df.schema[date].dataType)
    return df.withColumn(date, day).withColumn(period, period_start(F.col(quoted(date)), grain))


def sales_by_period(
    df: DataFrame,
    key: str,
    date: str = RETAIL.date,
    sales: str = RETAIL.sales,
    grain: str = "week",
    period: str = RETAIL.week,
    out: str | None = None,
) -> DataFrame:
    """Total sales per key and period."""
    return (
        add_period(df, date, grain, period)
        .groupBy(quoted(key), quoted(period))
        .agg(total(F.col(quoted(sales))).alias(out or f"{key} {grain.title()} Sales"))
    )


def sales_summary(
    df: DataFrame,
    key: str,
    date: str = RETAIL.date,
    sales: str = RETAIL.sales,
    grain: str = "week",
    period: str = RETAIL.week,
) -> DataFrame:
    """Total, average and number of sales per period and key."""
    measure = F.col(quoted(sales))
    return (
        add_period(df, date, grain, period)
        .groupBy(quoted(period), quoted(key))
        .agg(
            total(measure).alias("Total Sales"),
            average(measure).alias("Average Sales"),
            F.count(measure).alias("Transaction Count"),
        )
    )


# How the grains are called in names of columns and tables.
GRAIN_NAMES = {"day": "Daily", "week": "Weekly", "month": "Monthly"}


@dataclass(frozen=True)
class ForecastTables:
    city_weekly: DataFrame
    category_weekly: DataFrame
    city_summary: DataFrame
    category_summary: DataFrame


def forecast_tables(
    df: DataFrame, columns: SalesColumns = RETAIL, grain: str = "week", keep: bool = True
) -> ForecastTables:
    """Both sales tables and both summaries from one pass over the sales.

    The sales are reduced once to city, category and period; the four tables are
    read off that small result, which ``keep`` writes to the shared folder.
    """
    cells = period_cells(df, columns, grain)
    if keep:
        cells = materialise(cells, "forecast-cells")
    return tables_of_cells(cells, columns, grain)


def period_cells(df: DataFrame, columns: SalesColumns = RETAIL, grain: str = "week") -> DataFrame:
    """The sales reduced to city, category and period: exact sum (``__sum``) and number (``__n``).

    Cells of several tables can be added up to those of their union.
    """
    return (
        add_period(df, columns.date, grain, columns.week)
        .groupBy(*[quoted(c) for c in (columns.city, columns.category, columns.week)])
        .agg(F.sum(quoted(columns.sales)).alias("__sum"), F.count(quoted(columns.sales)).alias("__n"))
    )


def tables_of_cells(cells: DataFrame, columns: SalesColumns = RETAIL, grain: str = "week") -> ForecastTables:
    city = _summary_of_cells(cells, columns.city, columns.week)
    category = _summary_of_cells(cells, columns.category, columns.week)
    return ForecastTables(
        _sales_only(city, columns.city, columns.week, f"City {GRAIN_NAMES[grain]} Sales"),
        _sales_only(category, columns.category, columns.week, f"Category {GRAIN_NAMES[grain]} Sales"),
        city,
        category,
    )


def _summary_of_cells(cells: DataFrame, key: str, period: str) -> DataFrame:
    sales = total(F.col("__sum"))
    return cells.groupBy(quoted(period), quoted(key)).agg(
        sales.alias("Total Sales"),
        F.try_divide(sales, F.sum("__n")).alias("Average Sales"),
        F.sum("__n").alias("Transaction Count"),
    )


def _sales_only(summary: DataFrame, key: str, period: str, out: str) -> DataFrame:
    return summary.select(quoted(key), quoted(period), F.col("`Total Sales`").alias(out))


def date_bounds(df: DataFrame, date: str = RETAIL.date, by: Sequence[str] = ()) -> DataFrame:
    """First and last date, of the table or of each key."""
    return df.groupBy(*[quoted(c) for c in by]).agg(
        F.min(quoted(date)).alias("first_date"), F.max(quoted(date)).alias("last_date")
    )
