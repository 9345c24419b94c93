"""Duplicates by digest."""

import math

import pytest
from pyspark.sql import functions as F

from compare import plan
from weekloom.operators import dedup

ROWS = [
    ("a", 1, 0.0), ("a", 1, -0.0), ("a", 1, 0.0), (None, 1, 2.0), (None, 1, 2.0), ("a", None, 2.0), (None, None, None),
    (None, None, None), ("b", 1, math.nan), ("b", 1, math.nan), ("1", 1, 1.0), ("", 1, 1.0), ("truefalse", 1, 1.0),
]


def _table(spark):
    return spark.createDataFrame(ROWS, "row string, d1 int, found double").repartition(3)


def _sorted(df):
    return sorted([tuple(str(v).replace("-0.0", "0.0") for v in r) for r in df.collect()])


@pytest.mark.parametrize("most", [1_000_000, 2])
@pytest.mark.parametrize("keys", [None, ["row"], ["row", "d1"]])
def test_digests_find_what_rows_find(spark, monkeypatch, keys, most):
    monkeypatch.setattr(dedup, "MOST_DIGESTS", most)
    df = _table(spark)
    made = dedup.deduplicate(df, keys)
    wanted = dedup.drop_duplicates(df, keys)
    columns = keys or df.columns
    assert made.rows.columns == df.columns
    assert _sorted(made.rows.select(*columns)) == _sorted(wanted.select(*columns))
    groups = dedup.duplicate_groups(df, keys).agg(F.count("*"), F.sum(F.col("n_dup") - 1)).first()
    assert tuple(made.report.first()) == tuple(groups) == tuple(dedup.duplicate_counts(df, keys).first())


def test_single_rows_do_not_move(spark):
    df = spark.range(20_000).select((F.col("id") - F.when(F.col("id") % 100 == 0, 1).otherwise(0)).alias("k"), F.lit("wide " * 20).alias("text"))
    made = dedup.deduplicate(df)
    assert made.rows.count() == 20_000 - 199 and tuple(made.report.first()) == (199, 199)
    above = plan(made.rows).split("Exchange")[0]
    assert "Union" in above and "text" not in plan(dedup.duplicate_counts(df)).split("Exchange")[1]


def test_nothing_to_drop(spark):
    df = spark.range(100)
    made = dedup.deduplicate(df)
    assert made.rows is df and tuple(made.report.first()) == (0, 0)
    assert tuple(dedup.deduplicate(df.limit(0)).report.first()) == (0, 0)


def _most_in_a_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_a_task_compares_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(dedup, "ROWS_PER_PART", 1_000)
    # Every second row is the same one.
    df = spark.range(60_000).select((F.col("id") % 2 * F.col("id")).alias("k"), F.lit("wide " * 9).alias("text")).repartition(40)
    twice = df.where("k > 0").union(df.where("k > 0"))
    assert _most_in_a_task(dedup.drop_duplicates(df)) < 2_000
    assert _most_in_a_task(dedup.duplicate_groups(twice)) < 2_000
    assert dedup.duplicate_groups(df).collect() == [(0, "wide " * 9, 30_000)]
    assert dedup.drop_duplicates(df).count() == 30_001 and dedup.duplicate_groups(twice).count() == 30_000
