"""Forward fill and exact quantiles against brute force, on skewed input; plan shapes."""

import datetime
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from compare import plan
from pyspark.sql import functions as F

from weekloom.operators import aggregate, dedup, features, missing, outliers, spine
from weekloom.operators.forward_fill import forward_fill, in_ranges
from weekloom.plans.views import sales

few = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


# Ranges


def test_ranges_keep_the_order_and_are_even(spark):
    # A third of the rows share their first key column.
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("a"), "id")
    key = F.struct("row.a", "row.id")
    ranges = (
        in_ranges(df, ["a", "id"], 16)
        .groupBy("range")
        .agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        .orderBy("range")
        .collect()
    )
    assert len(ranges) == 16
    assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))
    assert max(r.n for r in ranges) < 3 * 30_000 / 16


def test_places_follow_the_order(spark):
    df = spark.range(5_000).select(F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id"), F.lit(997))).alias("a"), "id")
    rows = in_ranges(df, ["a", "id"], 300).orderBy("place").collect()
    keys = [(r.row.a is not None, r.row.a or 0, r.row.id) for r in rows]
    assert keys == sorted(keys) and len({r["place"] for r in rows}) == 5_000


def test_forward_fill_plan_sorts_no_rows_to_aggregate(spark):
    df = spark.range(1_000).select("id", F.when(F.col("id") % 9 == 0, F.col("id")).alias("v"))
    lines = plan(forward_fill(df, "v", ["id"], ranges=20)).splitlines()
    below = [lines[k:] for k, line in enumerate(lines) if "SortAggregate" in line]
    # Only the three picked rows of each range may be sorted; the scan of all of them may not.
    assert not any("SortAggregate" in line and "(place" in line for line in lines), below


# Forward fill


def fill_by_hand(frame, by):
    frame = frame.sort_values([*by, "at"], na_position="first")
    groups = frame.groupby(by, dropna=False)["v"] if by else frame["v"]
    return frame.assign(v=groups.ffill())


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("ranges", [1, 5, 32])
def test_forward_fill_with_a_hot_key(spark, by, ranges):
    random = np.random.default_rng(ranges)
    n = 900
    keys = np.where(random.random(n) < 1 / 3, "hot", random.choice(list("abcdef"), n)).astype(object)
    keys[random.random(n) < 0.05] = None
    frame = pd.DataFrame({"k": keys, "at": random.permutation(n), "v": random.integers(0, 1000, n).astype(float)})
    frame.loc[random.random(n) < 0.6, "v"] = None
    # The hot key has its only value at the front, so it crosses many ranges.
    hot = frame["k"] == "hot"
    frame.loc[hot, "v"] = None
    frame.loc[frame[hot]["at"].idxmin(), "v"] = -1.0
    rows = [(k, int(a), None if v != v else float(v)) for k, a, v in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "k string, at int, v double")
    got = {r.at: r.v for r in forward_fill(df, "v", ["at"], by, ranges=ranges).collect()}
    wanted = fill_by_hand(frame, by)
    assert got == {int(a): (None if v != v else v) for a, v in zip(wanted["at"], wanted["v"])}


def test_a_task_fills_few_ranges(spark):
    df = spark.range(40_000).select("id", F.when(F.col("id") % 9 == 0, F.col("id")).alias("v"))
    filled = forward_fill(df, "v", ["id"], ranges=40)
    held = filled.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held < 40_000 / 8
    assert filled.where("v <> id - id % 9").isEmpty()


def test_forward_fill_of_dates_ordered_by_time_and_text(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (start + datetime.timedelta(hours=i // 2), "ab"[i % 2], start.date() if i in (0, 5) else None)
        for i in range(12)
    ]
    df = spark.createDataFrame(rows, "t timestamp, s string, d date").withColumn(
        "d", F.when(F.col("t") >= F.lit(start + datetime.timedelta(hours=2)), F.date_add("d", 9)).otherwise(F.col("d"))
    )
    got = [r.d.day for r in forward_fill(df, "d", ["t", "s"], ranges=4).orderBy("t", "s").collect()]
    assert got == [1] * 5 + [10] * 7


def test_forward_fill_of_an_empty_or_all_null_table(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, v string")
    assert [r.v for r in forward_fill(df, "v", ["a"]).collect()] == [None, None]
    assert forward_fill(df.limit(0), "v", ["a"]).count() == 0


def test_forward_fill_spreads_a_table_with_one_key(spark, small):
    from weekloom.plans.views import KEY, dirty

    rows = dirty(spark, small, [*KEY, "date_hi"]).withColumn("k", F.lit("only"))
    filled = forward_fill(rows, "date_hi", KEY, ["k"], ranges=8)
    assert "SinglePartition" not in plan(filled)
    assert re.search(r"Exchange hashpartitioning\(range", plan(filled))


# Quantiles


def quantiles(df, columns, probabilities, **options):
    return {(r["column"], r.p): r.value for r in outliers.quantiles_exact(df, columns, probabilities, **options).collect()}


@pytest.mark.parametrize("accuracy", [4, 100, 10_000])
def test_exact_quantiles_of_skewed_values(spark, accuracy):
    random = np.random.default_rng(accuracy)
    values = {
        "tail": np.exp(random.normal(0, 4, 4000)),
        "hot": np.where(random.random(4000) < 1 / 3, 5.0, random.integers(0, 20, 4000).astype(float)),
        "one": np.full(4000, 3.0),
    }
    names = list(values)
    df = spark.createDataFrame([tuple(map(float, row)) for row in zip(*values.values())], names)
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = quantiles(df, names, probabilities, accuracy=accuracy)
    for name, column in values.items():
        for p in probabilities:
            assert got[name, p] == pytest.approx(np.quantile(column, p), rel=1e-12)


def test_a_sketch_that_missed_does_not_matter(spark, monkeypatch):
    wrong = F.array(*[F.lit(v) for v in (900.0, 950.0, 0.0, 10.0)])
    monkeypatch.setattr(outliers.F, "percentile_approx", lambda *_: F.any_value(wrong))
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert quantiles(df, ["v"], (0.25, 0.5)) == {("v", 0.25): 250.0, ("v", 0.5): 500.0}


def test_quantiles_with_nulls_and_few_rows(spark):
    df = spark.createDataFrame([(1.0, None), (None, 4), (3.0, None)], "a double, b int")
    assert quantiles(df, ["a", "b"], (0.25, 0.75)) == {
        ("a", 0.25): 1.5, ("a", 0.75): 2.5, ("b", 0.25): 4.0, ("b", 0.75): 4.0,
    }


# Properties

numbers = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=25)


@few
@given(numbers)
def test_capping_narrows_and_keeps_nulls(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    capped = {r.i: r.v for r in outliers.handle_outliers(df, ["v"]).collect()}
    known = [v for v in values if v is not None]
    for i, v in enumerate(values):
        assert (capped[i] is None) == (v is None)
        if v is not None:
            assert min(known) <= capped[i] <= max(known)


@few
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 2)), min_size=1, max_size=25))
def test_dedup_leaves_the_set(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int")
    once = dedup.drop_duplicates(df)
    assert sorted(map(tuple, once.collect())) == sorted(set(rows))
    surplus = dedup.duplicate_counts(df).first()["surplus_rows"]
    assert surplus == len(rows) - len(set(rows))


@few
@given(st.lists(st.integers(0, 200), min_size=1, max_size=10))
def test_spine_has_no_gaps(spark, offsets):
    start = datetime.date(2024, 1, 1)
    df = spark.createDataFrame([(start + datetime.timedelta(days=o),) for o in offsets], "`Week Start` date")
    weeks = sorted(r[0] for r in spine.spine(df).collect())
    assert all(b - a == datetime.timedelta(days=7) for a, b in zip(weeks, weeks[1:]))
    first = start + datetime.timedelta(days=min(offsets) // 7 * 7)
    assert weeks[0] == first and len(weeks) == max(offsets) // 7 - min(offsets) // 7 + 1


@few
@given(st.lists(st.one_of(st.none(), st.sampled_from("abc")), min_size=1, max_size=20))
def test_fills_leave_no_nulls_unless_all_are(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    filled = [r.c for r in missing.fill_mode(df, "c").collect()]
    assert (None in filled) == (set(values) == {None})
    assert None not in [r.c for r in missing.fill_constant(df, "c", "z").collect()]


# Plans


def test_all_windows_share_one_shuffle(spark, small):
    weekly = spark.createDataFrame([("a", datetime.date(2024, 1, 1), 1.0)], "g string, `Week Start` date, s double")
    assert plan(features.add_all(weekly, "g", "s")).count("Exchange hashpartitioning") == 1


def test_only_needed_columns_are_read(spark, small):
    weekly = aggregate.sales_by_period(
        sales(spark, small, ("invoice_date", "category", "total_sales")), "category", "invoice_date", "total_sales"
    )
    read = re.findall(r"ReadSchema: struct<([^>]*)>", weekly._jdf.queryExecution().executedPlan().verboseStringWithOperatorId()) or re.findall(
        r"FileScan parquet \[([^\]]*)\]", plan(weekly)
    )
    assert len(read) == 3
    assert not any("l_tax" in r or "o_totalprice" in r or "p_name" in r for r in read)


def test_filters_reach_the_scan(spark, small):
    from weekloom.operators.quality import nonpositive_sales
    from weekloom.plans.views import table

    text = plan(nonpositive_sales(table(spark, small, "customer"), "c_acctbal"))
    assert "LessThanOrEqual(c_acctbal,0.0)" in text
