"""NaN in numeric columns, ranges of quantiles, and input columns with the names of inner ones."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.operators import outliers
from weekloom.operators.forward_fill import forward_fill


def _column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def test_nan_moves_no_fence_and_is_not_capped(spark):
    numbers = [float(v) for v in (1, 2, 3, 4, 5, 6, 7, 8, 9, 500)]
    fences = [outliers.collect_fences(outliers.iqr_fences(_column(spark, numbers + extra)))["v"] for extra in ([], [math.nan] * 9, [None, math.nan] * 3)]
    assert fences[0] == fences[1] == fences[2]
    capped = outliers.handle_outliers(_column(spark, numbers + [math.nan] * 9 + [None])).collect()
    assert sorted(r.v for r in capped if r.v is not None and r.v == r.v) == [*numbers[:9], fences[0][1]]
    assert sum(r.v is not None and r.v != r.v for r in capped) == 9 and sum(r.v is None for r in capped) == 1
    report = outliers.outlier_report(_column(spark, numbers + [math.nan] * 9), {"v": fences[0]}).first()
    assert report.outliers == 1


def test_a_column_of_nan_has_no_quartiles(spark):
    df = _column(spark, [math.nan, math.nan, None]).withColumn("f", F.col("v").cast("float"))
    assert [r.value for r in outliers.quantiles_exact(df, ["v", "f"]).collect()] == [None] * 4
    assert outliers.handle_outliers(df).where("isnan(v) and isnan(f)").count() == 2


def test_floats_with_nan_are_capped_as_floats(spark):
    df = _column(spark, [1.0, 2.0, 3.0, 900.0, math.nan]).select(F.col("v").cast("float").alias("v"))
    got = outliers.cap_outliers(df, {"v": (0.0, 10.0)})
    assert got.schema == df.schema and sorted(str(r.v) for r in got.collect()) == ["1.0", "10.0", "2.0", "3.0", "nan"]


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_ranges_hold_few_values_whatever_the_spread(spark, monkeypatch, accuracy):
    monkeypatch.setattr(outliers, "RANGE_VALUES", 50)
    exponents = np.random.default_rng(2).uniform(-300, 300, 20_000)
    values = [float(v) for v in 10.0**exponents]
    seen = []
    whole = outliers._ranged

    def spied(counted):
        seen.append(whole(counted))
        return seen[-1]

    monkeypatch.setattr(outliers, "_ranged", spied)
    df = _column(spark, values + values[:5_000]).repartition(7)
    got = {r.p: r.value for r in outliers.quantiles_exact(df, ["v"], (0.1, 0.25, 0.5, 0.75, 0.9), accuracy=accuracy).collect()}
    every = np.array(values + values[:5_000])
    for p, value in got.items():
        assert value == pytest.approx(np.quantile(every, p), rel=1e-12)
    for cells in seen:
        sizes = [r["count"] for r in cells.groupBy("b", "zone").count().collect()]
        assert sum(sizes) < 1_000 or max(sizes) <= sum(sizes) / 100 * 3


def test_forward_fill_leaves_other_columns_alone(spark):
    rows = [(i, i * 10, None if i % 3 else float(i), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, `__range` int, v double, row int")
    for name in ("range", "place", "carry", "group", "value", "filled", "__place", "first"):
        df = df.withColumn(name, F.col("id") + 1000)
    for by in ([], ["row"]):
        got = forward_fill(df, "v", ["id"], by, ranges=7)
        assert got.columns == df.columns
        rows = got.orderBy("id").collect()
        assert [(r["__range"], r["place"], r["carry"], r["filled"]) for r in rows] == [(i * 10, i + 1000, i + 1000, i + 1000) for i in range(60)]
        if not by:
            assert [r.v for r in rows] == [float(i - i % 3) for i in range(60)]


def test_forward_fill_of_the_key_columns_neighbours(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5), (3, "b", None), (4, "a", None)], "id int, range string, place int")
    got = forward_fill(df, "place", ["id"], ["range"], ranges=3).orderBy("id").collect()
    assert [r.place for r in got] == [None, 5, None, 5]
