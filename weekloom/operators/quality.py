"""Data quality report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.columns import RETAIL, SalesColumns
from weekloom.operators.dedup import duplicate_counts, duplicate_groups
from weekloom.operators.profile import distinct_values
from weekloom.operators.ranking import first_dates, random_sample
from weekloom.functions.dates import as_date
from weekloom.operators.schema import one_row_per, quoted, rejected
from weekloom.operators.spine import missing_periods


def expected_types(columns: SalesColumns = RETAIL) -> dict[str, str]:
    """Types after the dates are parsed."""
    return {**columns.required, columns.date: "date"}


def nonpositive_sales(df: DataFrame, sales: str = RETAIL.sales) -> DataFrame:
    return df.where(F.col(quoted(sales)) <= 0)


def table_counts(df: DataFrame, columns: SalesColumns = RETAIL) -> dict[tuple[str, str], Column]:
    """The checks that are counts over all rows, by check and subject. They can be observed while rows are written."""
    rows = {("rows", "table"): F.count(F.lit(1))}
    for c in df.columns:
        rows["nulls", c] = F.count(F.lit(1)) - F.count(quoted(c))
    rows["not positive", columns.sales] = F.count_if(F.col(quoted(columns.sales)) <= 0)
    return rows


def quality_report(
    df: DataFrame,
    columns: SalesColumns = RETAIL,
    types: Mapping[str, str] | None = None,
    counted: Mapping[tuple[str, str], int] | None = None,
) -> DataFrame:
    """All checks as rows (check, subject, value, status); status is ``info`` where nothing is tested.

    Nulls, types and range share one pass, or none if ``counted`` brings what ``table_counts`` counts; distinct values,
    duplicates and missing weeks need a shuffle of their own.
    """
    types = expected_types(columns) if types is None else types
    rows = table_counts(df, columns)
    types_differ = [
        _check("type differs", c, F.lit(int(df.schema[c].dataType.simpleString() != t)).cast("bigint"))
        for c, t in types.items()
    ]
    names = {key: f"check_{i}" for i, key in enumerate(rows)}
    checks = {name: _check(*key, F.col(name)) for key, name in names.items()}
    checks |= {f"type_{i}": check for i, check in enumerate(types_differ)}
    if counted is None:
        row = df.agg(*[rows[key].alias(name) for key, name in names.items()])
    else:
        row = df.sparkSession.range(1).select(*[F.lit(counted[key]).cast("long").alias(name) for key, name in names.items()])
    one_pass = row.select(one_row_per(checks, "label"))
    # Few combinations of categories: their distinct values are counted without copies of every row.
    groups = df.groupBy(*[quoted(c) for c in (columns.city, columns.category)]).agg(F.lit(1).alias("one"))
    distinct = {
        c: _check("distinct values", c, F.col(f"n_{i}")) for i, c in enumerate((columns.city, columns.category))
    }
    distinct_values_of = groups.agg(
        *[F.count_distinct(F.col(quoted(c))).alias(f"n_{i}") for i, c in enumerate((columns.city, columns.category))]
    ).select(one_row_per(distinct, "label"))
    surplus = _check("surplus duplicates", "table", F.col("surplus_rows"))
    gaps = _check("missing weeks", columns.date, F.col("weeks"))
    missing = missing_periods(df, columns.date).agg(F.count(F.lit(1)).alias("weeks"))
    return (
        one_pass.drop("label")
        .unionByName(distinct_values_of.drop("label"))
        .unionByName(duplicate_counts(df).select(*[c.alias(n) for n, c in surplus.items()]))
        .unionByName(missing.select(*[c.alias(n) for n, c in gaps.items()]))
    )


def rejects(raw: DataFrame, columns: SalesColumns = RETAIL) -> DataFrame:
    """Values of the raw rows that coercion loses, as rows of a quality report: dates and sales
    that can't be read, and sales that are rounded. One pass."""
    day = as_date(F.col(quoted(columns.date)), raw.schema[columns.date].dataType)
    sales, kind = F.col(quoted(columns.sales)), columns.required[columns.sales]
    exact, kept = sales.try_cast("decimal(38,18)"), sales.try_cast(kind)
    rows = {
        ("rejected", columns.date): rejected(F.col(quoted(columns.date)), day),
        ("rejected", columns.sales): rejected(sales, kind),
        ("rounded", columns.sales): F.count_if(exact != kept.cast("decimal(38,18)")),
    }
    names = {key: f"check_{i}" for i, key in enumerate(rows)}
    counted = raw.agg(*[rows[key].alias(name) for key, name in names.items()])
    return counted.select(
        one_row_per({name: _check(*key, F.col(name)) for key, name in names.items()}, "label")
    ).drop("label")


def _check(check: str, subject: str, value: Column) -> dict[str, Column]:
    """A value that should be zero, unless it only informs."""
    status = F.when(value == 0, "ok").otherwise("failed")
    return {
        "check": F.lit(check),
        "subject": F.lit(subject),
        "value": value,
        "status": F.lit("info") if check in ("rows", "distinct values") else status,
    }


@dataclass(frozen=True)
class QualityDetails:
    report: DataFrame
    nonpositive: DataFrame
    duplicates: DataFrame
    cities: DataFrame
    categories: DataFrame
    first_dates: DataFrame
    sample: DataFrame


def run_quality_checks(
    df: DataFrame,
    columns: SalesColumns = RETAIL,
    seed: int | None = None,
    counted: Mapping[tuple[str, str], int] | None = None,
) -> QualityDetails:
    """The report and, lazily, the rows behind it; ``counted`` as of ``quality_report``."""
    return QualityDetails(
        report=quality_report(df, columns, counted=counted),
        nonpositive=nonpositive_sales(df, columns.sales),
        duplicates=duplicate_groups(df),
        cities=distinct_values(df, columns.city),
        categories=distinct_values(df, columns.category),
        first_dates=first_dates(df, columns.date),
        sample=random_sample(df, 10, seed),
    )
