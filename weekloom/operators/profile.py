"""Profile of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.dedup import duplicate_counts
from weekloom.operators.missing import null_counts
from weekloom.operators.outliers import quantiles_approx, quantiles_exact
from weekloom.operators.schema import aggregate_columns, numeric_columns, quoted, schema_report
from weekloom.operators.sketches import column_sketches, distinct_estimates
from weekloom.operators.top_values import top_values

SUMMARY_QUANTILES = (0.25, 0.5, 0.75)
_SUMMARY_SCHEMA = (
    "column string, count bigint, mean double, stddev double, min double, "
    "q25 double, q50 double, q75 double, max double"
)


def overview(df: DataFrame) -> DataFrame:
    """Number of rows and columns, and the column names."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), F.lit(", ".join(df.columns)).alias("names")
    )


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "approx"
) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per numeric column."""
    columns = numeric_columns(df) if columns is None else list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], _SUMMARY_SCHEMA)
    number = {c: F.col(quoted(c)).cast("double") for c in columns}
    moments = aggregate_columns(
        df,
        {
            c: {
                "count": F.count(number[c]),
                "mean": F.avg(number[c]),
                "stddev": F.stddev_samp(number[c]),
                "min": F.min(number[c]),
                "max": F.max(number[c]),
            }
            for c in columns
        },
    )
    quantiles = quantiles_exact if method == "exact" else quantiles_approx
    quartiles = (
        quantiles(df, columns, SUMMARY_QUANTILES)
        .groupBy("column")
        .agg(
            *[
                F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"q{round(100 * p)}")
                for p in SUMMARY_QUANTILES
            ]
        )
    )
    return moments.join(quartiles, "column").select(
        "column", "count", "mean", "stddev", "min", "q25", "q50", "q75", "max"
    )


def text_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, first and last value in text order of the columns that hold no numbers."""
    if columns is None:
        numbers = set(numeric_columns(df))
        columns = [c for c in df.columns if c not in numbers]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, count bigint, min string, max string")
    text = {c: F.col(quoted(c)).cast("string") for c in columns}
    return aggregate_columns(
        df, {c: {"count": F.count(t), "min": F.min(t), "max": F.max(t)} for c, t in text.items()}
    )


def value_counts(
    df: DataFrame, columns: Sequence[str] | None = None, top: int | None = None
) -> DataFrame:
    """How often each value of each column occurs, nulls included; one scan for all columns.

    ``top`` keeps that many of each column, the most frequent ones; values that can't be among them
    are not shuffled.
    """
    columns = df.columns if columns is None else list(columns)
    if top is not None:
        return top_values(df, columns, top)
    texts = [F.col(quoted(c)).cast("string").alias(c) for c in columns]
    return (
        df.select(*texts)
        .unpivot([], [quoted(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent_first(counts: DataFrame) -> DataFrame:
    return counts.orderBy("column", F.desc("n"), "value")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct()


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool | None = None
) -> DataFrame:
    """Number of different non-null values per column.

    Exact for the columns that are named. For all columns of a table, or with ``approximate``, sketches in
    one pass estimate it, to about 1.6 percent.
    """
    if columns is None if approximate is None else approximate:
        return distinct_estimates(column_sketches(df, columns)).select("column", "n_distinct")
    columns = df.columns if columns is None else columns
    return aggregate_columns(df, {c: {"n_distinct": F.count_distinct(F.col(quoted(c)))} for c in columns})


_value_counts = value_counts
_PARTS = {
    "schema": {"schema": schema_report},
    "overview": {"overview": overview},
    "summary": {"summary": numeric_summary, "text_summary": text_summary},
    "nulls": {"nulls": null_counts},
    "duplicates": {"duplicates": duplicate_counts},
    "value_counts": {"value_counts": lambda df: value_counts(df)},
}


def explore(
    df: DataFrame,
    schema: bool = False,
    overview: bool = False,
    summary: bool = False,
    nulls: bool = False,
    duplicates: bool = False,
    value_counts: bool = False,
    all: bool = False,
    top: int | None = 20,
) -> dict[str, DataFrame]:
    """The chosen parts of the profile, by name.

    Of each column the ``top`` most frequent values are counted, in that order; with
    ``None`` all of them, unsorted.
    """
    flags = {
        "schema": schema,
        "overview": overview,
        "summary": summary,
        "nulls": nulls,
        "duplicates": duplicates,
        "value_counts": value_counts,
    }
    chosen = {
        name: build(df)
        for flag, parts in _PARTS.items()
        if all or flags[flag]
        for name, build in parts.items()
    }
    if "value_counts" in chosen and top is not None:
        chosen["value_counts"] = most_frequent_first(_value_counts(df, top=top))
    return chosen
