"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from weekloom.plans.catalog import QUERIES  # noqa: E402
from weekloom.session import local_session  # noqa: E402

HEADLINE = [
    "weekly_category_sales",
    "weekly_city_sales",
    "weekly_city_summary",
    "daily_sales",
    "forecast_tables",
    "null_share",
    "mode_fill",
    "date_policy_fill",
    "regression_impute",
    "clean_sales",
    "drop_duplicates",
    "quartiles_exact",
    "cap_outliers",
    "value_counts",
    "features_run_all",
    "features_add_all",
    "date_continuity",
    "quality_report",
    "wrangle_to_features",
]


def run(name: str, spark, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    # Once to let the JVM compile the code of the plans, once on the clock. The
    # intermediate tables of the first round are not used again.
    for name in HEADLINE:
        run(name, spark, folder)
    seconds = {name: round(run(name, spark, folder), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": pathlib.Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
