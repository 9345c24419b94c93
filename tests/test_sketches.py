"""Mergeable sketches and top values."""

import math

import pytest
from pyspark.sql import functions as F

from compare import plan
from weekloom.operators import profile, sketches, top_values


def _rows(spark, n=40_000):
    day = F.col("id") % 31
    return spark.range(n).select(
        day.alias("day"), (F.col("id") * 7919 % 5_003).alias("k"), F.sqrt(F.col("id").cast("double")).alias("v"),
        F.when(day > 40, F.lit("x")).alias("never"), F.concat(F.lit("t"), F.col("id") % 11).alias("t"),
    )


def test_merged_sketches_tell_what_the_whole_tells(spark):
    df = _rows(spark)
    daily = sketches.column_sketches(df, by=["day"])
    path_free = daily.columns
    assert path_free == ["day", "column", "rows", "filled", "distinct", "quantiles"]
    merged = sketches.merge_sketches(daily)
    found = {r["column"]: r for r in sketches.distinct_estimates(merged).collect()}
    assert {c: (r["rows"], r["filled"]) for c, r in found.items()} == {c: (40_000, 0 if c == "never" else 40_000) for c in df.columns}
    for c, true in {"day": 31, "k": 5_003, "v": 40_000, "never": 0, "t": 11}.items():
        assert found[c]["n_distinct"] == pytest.approx(true, rel=0.05)
    quantiles = sketches.quantile_estimates(merged, [0.1, 0.5, 0.9]).where("column = 'v'").collect()
    for r in quantiles:
        assert r["value"] ** 2 / 40_000 == pytest.approx(r["p"], abs=0.01)
    assert {r["column"] for r in sketches.quantile_estimates(merged, [0.5]).collect()} == {"day", "k", "v"}


def test_sketches_survive_storage_and_any_grouping(spark, tmp_path):
    sketches.column_sketches(_rows(spark, 5_000), ["k", "v"], ["day"]).write.parquet(str(tmp_path / "daily"))
    stored = spark.read.parquet(str(tmp_path / "daily"))
    tens = sketches.merge_sketches(stored, [F.floor(F.col("day") / 10).alias("ten")])
    once = {r["column"]: r["n_distinct"] for r in sketches.distinct_estimates(sketches.merge_sketches(stored)).collect()}
    twice = {r["column"]: r["n_distinct"] for r in sketches.distinct_estimates(sketches.merge_sketches(tens)).collect()}
    assert tens.count() == 8
    for c, true in (("k", 5_000), ("v", 5_000)):
        assert once[c] == pytest.approx(true, rel=0.05) and twice[c] == pytest.approx(true, rel=0.05)


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(None, math.nan), (None, None)], "a int, b double")
    made = sketches.column_sketches(df)
    assert sketches.quantile_estimates(made, [0.5]).count() == 0
    assert {r["column"]: r["n_distinct"] for r in sketches.distinct_estimates(made).collect()} == {"a": 0, "b": 1}
    assert sketches.distinct_estimates(sketches.merge_sketches(made.where("false"))).count() == 0
    assert profile.distinct_counts(df.limit(0)).select("n_distinct").distinct().collect()[0][0] == 0


def test_all_columns_are_estimated_without_copies_of_rows(spark):
    df = _rows(spark)
    assert "Expand" not in plan(profile.distinct_counts(df))
    assert {r["column"]: r["n_distinct"] for r in profile.distinct_counts(df, ["k", "t"]).collect()} == {"k": 5_003, "t": 11}


def _by_hand(df, columns, n):
    out = []
    for c in columns:
        counts = {}
        for r in df.select(F.col(f"`{c}`").cast("string")).collect():
            counts[r[0]] = counts.get(r[0], 0) + 1
        best = sorted(counts.items(), key=lambda i: (-i[1], i[0] is not None, i[0] or ""))[:n]
        out += [(c, v, k) for v, k in best]
    return sorted(out, key=str)


def _top(df, columns, n):
    return sorted([tuple(r) for r in top_values.top_values(df, columns, n).collect()], key=str)


@pytest.mark.parametrize("tracked,hashes", [(8_000, 100_000), (40, 100_000), (40, 3)])
def test_top_values_of_every_kind_of_column(spark, monkeypatch, tracked, hashes):
    monkeypatch.setattr(top_values, "TRACKED", tracked)
    size = 1
    while 0.75 * size < tracked:
        size *= 2
    monkeypatch.setattr(top_values, "ERROR", 3.5 / size)
    monkeypatch.setattr(top_values, "MOST_HASHES", hashes)
    df = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("a.b"),
        F.col("id").alias("single"),
        (F.col("id") / 2).cast("long").alias("pairs"),
        F.when(F.col("id") % 2 == 0, F.sqrt("id")).alias("nulls"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("id") % 5 == 0, "").when(F.col("id") % 5 == 1, "=").alias("signs"),
        F.pow(F.lit(1.001), F.col("id")).cast("long").alias("flat"),
    ).repartition(5)
    for n in (1, 3, 20):
        assert _top(df, df.columns, n) == _by_hand(df, df.columns, n)


def test_top_values_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert top_values.top_values(empty, ["a", "b"], 3).collect() == []
    assert profile.value_counts(empty, top=2).columns == ["column", "value", "n"]


def test_frequent_values_alone_are_shuffled(spark, monkeypatch):
    """A column with few values is proven by its candidates; none of its cells is counted by value or hash."""
    monkeypatch.setattr(top_values, "_by_hash", lambda *_: pytest.fail("not proven"))
    df = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, F.lit("x")).otherwise((F.col("id") % 31).cast("string")).alias("a"))
    assert _top(df, ["a"], 5) == _by_hand(df, ["a"], 5)
