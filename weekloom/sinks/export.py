"""Versioned, distributed export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from weekloom.sources.versions import reserve_version, settle

# Names under which the tables are exported.
MAIN = "main_data"
CITY_WEEKLY = "city_sales_weekly"
CATEGORY_WEEKLY = "category_sales_weekly"


def export_version(
    df: DataFrame,
    folder: str,
    name: str,
    file_type: str = "parquet",
    order_by: Sequence[str] = (),
    **options,
) -> str:
    """Write ``df`` as the next version of ``name`` and return its path.

    The number is claimed before anything is written, whatever the file type, and the claim
    says when the version is whole. Of two writers that pick the same number, at most one keeps it.
    """
    if file_type not in ("csv", "parquet"):
        raise ValueError(f"unsupported file type: {file_type}")
    claim = reserve_version(df.sparkSession, folder, name)
    path = f"{folder.rstrip('/')}/{name}_v{claim.number}.{file_type}"
    if order_by:
        df = df.orderBy(*order_by)
    if file_type == "csv":
        options = {"header": True, **options}
    try:
        df.write.mode("errorifexists").format(file_type).options(**options).save(path)
    except BaseException:
        settle(df.sparkSession, claim, "failed")
        raise
    settle(df.sparkSession, claim, "published")
    return path


def export_cleaned(
    folder: str,
    main: DataFrame,
    city_weekly: DataFrame,
    category_weekly: DataFrame,
    week: str = "Week Start",
    file_type: str = "parquet",
) -> dict[str, str]:
    """Export the cleaned rows and both weekly tables."""
    return {
        MAIN: export_version(main, folder, MAIN, file_type),
        CITY_WEEKLY: export_version(city_weekly, folder, CITY_WEEKLY, file_type, [week]),
        CATEGORY_WEEKLY: export_version(category_weekly, folder, CATEGORY_WEEKLY, file_type, [week]),
    }


def export_features(
    folder: str,
    main: DataFrame | None = None,
    city: DataFrame | None = None,
    category: DataFrame | None = None,
    file_type: str = "parquet",
) -> dict[str, str]:
    """Export whichever feature tables are given."""
    given = {MAIN: main, CITY_WEEKLY: city, CATEGORY_WEEKLY: category}
    return {
        f"{name}_features": export_version(df, folder, f"{name}_features", file_type)
        for name, df in given.items()
        if df is not None
    }
