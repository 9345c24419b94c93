"""Reports that are counted while the rows are written."""

import math

import pytest
from pyspark.sql import functions as F

from compare import plan
from weekloom.operators import outliers, quality
from weekloom.plans.wrangle import wrangle


def _raw(spark):
    return spark.range(3_000).select(
        F.concat(F.lit("city "), F.col("id") % 7).alias("City"),
        F.when(F.col("id") % 500 != 0, F.concat(F.lit("kind "), F.col("id") % 3)).alias("Product Category"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")), "MM/dd/yyyy").alias("Invoice Date"),
        F.when(F.col("id") % 100 == 0, -5.0).when(F.col("id") % 111 == 0, 1e6).otherwise(F.col("id") / 10.0).cast("string").alias("Total Sales"),
        F.when(F.col("id") % 9 == 0, F.lit(math.nan)).when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 50).alias("weight"),
    )


@pytest.mark.parametrize("file_type", ["parquet", "csv"])
def test_observed_counts_are_those_of_a_scan(spark, tmp_path, file_type):
    made = wrangle(_raw(spark), str(tmp_path), file_type=file_type)
    key = ["check", "subject"]
    observed = sorted(map(tuple, made.quality.report.where("check <> 'rejected' and check <> 'rounded'").collect()))
    scanned = sorted(map(tuple, quality.quality_report(made.main).collect()))
    assert observed == scanned and any(r[0] == "nulls" and r[2] for r in observed), key
    found = {r["column"]: r["outliers"] for r in made.outliers.collect()}
    assert found["Total Sales"] == 27 and found["weight"] == 0


def test_counts_need_no_scan(spark, tmp_path):
    made = wrangle(_raw(spark), str(tmp_path))
    assert "FileScan" not in plan(made.outliers)
    scans = [plan(quality.quality_report(made.main, counted=c)).count("FileScan") for c in (None, {k: 0 for k in quality.table_counts(made.main)})]
    assert scans[1] == scans[0] - 1
    fences = {"weight": (0.0, 10.0)}
    assert outliers.outlier_report(made.main, fences, {"weight": 3}).collect()[0].outliers == 3
