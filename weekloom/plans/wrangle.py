"""From raw rows to exported tables, and from those to exported features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession

from weekloom.columns import RETAIL, SalesColumns
from weekloom.operators.aggregate import GRAIN_NAMES, ForecastTables, add_period, forecast_tables
from weekloom.operators.features import run_all
from weekloom.operators.outliers import cap_outliers, collect_fences, iqr_fences, outlier_counts, outlier_report
from weekloom.operators.quality import QualityDetails, rejects, run_quality_checks, table_counts
from weekloom.operators.schema import coerce_types, numeric_columns
from weekloom.plans.clean import clean_with_report
from weekloom.shared import materialise
from weekloom.sinks.export import (
    CATEGORY_WEEKLY,
    CITY_WEEKLY,
    MAIN,
    export_features,
    export_version,
)
from weekloom.sources.read import load_data
from weekloom.sources.versions import read_latest


@dataclass(frozen=True)
class Wrangled:
    """``outliers``: fences and capped values per column; ``duplicates``: one row with those dropped;
    ``tables``: of the first grain, ``by_grain`` of each."""

    main: DataFrame
    tables: ForecastTables
    quality: QualityDetails
    paths: dict[str, str]
    outliers: DataFrame | None
    duplicates: DataFrame
    by_grain: dict[str, ForecastTables]


def wrangle(
    raw: DataFrame,
    folder: str,
    columns: SalesColumns = RETAIL,
    file_type: str = "parquet",
    outliers: str = "exact",
    keep: bool = True,
    grains: Sequence[str] = ("week",),
    **cleaning,
) -> Wrangled:
    """Clean, coerce, cap, aggregate, check and export.

    ``keep`` writes the cleaned rows to the shared folder before quartiles and
    the export read them, instead of cleaning the raw rows anew for each. What the reports count
    over all rows is counted by the export; the aggregates and other checks read what was exported. For each of ``grains`` the sales
    of cities and categories are exported, as ``city_sales_daily`` for days.
    """
    made = clean_with_report(raw, columns, **cleaning)
    cleaned = coerce_types(made.rows, columns.required)
    if keep:
        cleaned = materialise(cleaned, "cleaned-sales")
    numbers = numeric_columns(cleaned)
    fences = collect_fences(iqr_fences(cleaned, numbers, outliers)) if numbers else {}
    main = add_period(cap_outliers(cleaned, fences), columns.date, "week", columns.week)
    paths, counted, outside = _export_observed(cleaned, fences, columns, folder, file_type)
    # A CSV would not give the types back.
    stored = load_data(raw.sparkSession, paths[MAIN], file_type, main.schema)
    stored = stored if file_type == "parquet" else main
    by_grain = {grain: forecast_tables(stored, columns, grain, keep) for grain in grains}
    for grain, tables in by_grain.items():
        for name, table in ((CITY_WEEKLY, tables.city_weekly), (CATEGORY_WEEKLY, tables.category_weekly)):
            name = name.replace("weekly", GRAIN_NAMES[grain].lower())
            paths[name] = export_version(table, folder, name, file_type, [columns.week])
    details = run_quality_checks(stored, columns, counted=counted)
    details = replace(details, report=details.report.unionByName(rejects(raw, columns)))
    report = outlier_report(cleaned, fences, outside) if fences else None
    return Wrangled(stored, by_grain[grains[0]], details, paths, report, made.duplicates, by_grain)


def _export_observed(cleaned: DataFrame, fences, columns: SalesColumns, folder: str, file_type: str):
    """Export the capped rows, and count in the same pass what the reports need: values outside the fences
    before they are capped, nulls and range after. No row moves between the counts and the write, so each
    counts once, whatever tasks are repeated."""
    before, after = Observation(), Observation()
    outside = outlier_counts(cleaned, fences)
    if outside:
        cleaned = cleaned.observe(before, *[c.alias(f"outside {i}") for i, c in enumerate(outside.values())])
    main = add_period(cap_outliers(cleaned, fences), columns.date, "week", columns.week)
    counts = table_counts(main, columns)
    main = main.observe(after, *[c.alias(f"count {i}") for i, c in enumerate(counts.values())])
    paths = {MAIN: export_version(main, folder, MAIN, file_type)}
    seen = after.get
    counted = {key: seen[f"count {i}"] for i, key in enumerate(counts)}
    seen = before.get if outside else {}
    return paths, counted, {column: seen[f"outside {i}"] for i, column in enumerate(outside)}


def build_features(
    spark: SparkSession,
    folder: str,
    columns: SalesColumns = RETAIL,
    lags: Sequence[int] = (1, 2, 4),
    windows: Sequence[int] = (2, 4),
    file_type: str = "parquet",
) -> dict[str, str]:
    """Read the newest weekly tables, add features to the categories, export both.

    The city table is exported as it is.
    """
    category = read_latest(spark, folder, CATEGORY_WEEKLY)
    city = read_latest(spark, folder, CITY_WEEKLY)
    featured = run_all(
        category, columns.category, "Category Weekly Sales", lags, windows, columns.week
    )
    return export_features(folder, city=city, category=featured, file_type=file_type)
