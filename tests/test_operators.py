import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.functions import dates, text
from weekloom.operators import (
    aggregate,
    dedup,
    features,
    missing,
    outliers,
    profile,
    quality,
    ranking,
    regression,
    schema,
    spine,
)
from weekloom.plans.clean import clean

D = datetime.date


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


# Schema


def test_required_columns_are_named(spark):
    df = spark.sql("SELECT 1 AS City")
    with pytest.raises(ValueError, match="Invoice Date, Product Category, Total Sales"):
        schema.require_columns(df)


def test_coercion_turns_bad_values_into_null(spark):
    df = spark.createDataFrame(
        [("1/5/2024", "a", "b", "12.5"), ("x", "a", "b", "n/a")],
        "`Invoice Date` string, City string, `Product Category` string, `Total Sales` string",
    )
    typed = schema.coerce_types(df)
    assert [r["Total Sales"] for r in typed.collect()] == [Decimal("12.5"), None]
    checked = {r["column"]: r for r in schema.type_check(df, {"Total Sales": "decimal(18,4)"}).collect()}
    assert checked["Total Sales"]["rejected"] == 1 and not checked["Total Sales"]["ok"]


def test_drop_ignores_absent_columns(spark):
    assert schema.drop_columns(spark.sql("SELECT 1 AS Channel, 2 AS x")).columns == ["x"]


def test_all_numeric_types_count(spark):
    df = spark.sql("SELECT 1 AS i, 2L AS l, 1.5D AS d, CAST(1 AS FLOAT) AS f, 1.5BD AS m, 'x' AS s, DATE '2024-01-01' AS t")
    assert schema.numeric_columns(df) == ["i", "l", "d", "f", "m"]


def test_schema_report_of_an_empty_table(spark):
    rows = schema.schema_report(spark.sql("SELECT 1 AS a WHERE false")).collect()
    assert [(r["column"], r["type"], r["filled"]) for r in rows] == [("a", "int", 0)]


# Text and dates


@pytest.mark.parametrize(
    "raw, tidy",
    [("  Ar Riyād*& ", "ar riyd"), ("AL-KHOBAR 2", "al-khobar 2"), ("x *", "x "), ("\tx", "x"), (None, None)],
)
def test_tidy(spark, raw, tidy):
    assert value(spark, text.tidy(F.lit(raw).cast("string"))) == tidy


def test_tidy_variants(spark):
    assert value(spark, text.tidy(F.lit("\t x *"), all_whitespace=True, retrim=True)) == "x"


@pytest.mark.parametrize(
    "raw, day",
    [("1/5/2024", D(2024, 1, 5)), ("01/05/2024", D(2024, 1, 5)), ("n/a", None), ("13/40/2024", None)],
)
def test_parse_date(spark, raw, day):
    assert value(spark, dates.parse_date(F.lit(raw))) == day


def test_week_starts_on_monday(spark):
    assert value(spark, dates.week_start(F.lit(D(2024, 1, 7)))) == D(2024, 1, 1)
    assert value(spark, dates.period_start(F.lit(D(2024, 1, 7)), "month")) == D(2024, 1, 1)
    with pytest.raises(ValueError):
        dates.period_start(F.lit(D(2024, 1, 7)), "decade")


def test_iso_year_at_new_year(spark):
    day = F.lit(D(2021, 1, 3))
    parts = {n: value(spark, c) for n, c in dates.date_parts(day).items()}
    assert parts == {"week_of_year": 53, "month": 1, "year": 2021, "quarter": 1}
    assert value(spark, dates.iso_year(day)) == 2020
    names = {n: value(spark, c) for n, c in dates.date_names(day).items()}
    assert names == {"day_name": "Sunday", "week_name": "2020-W53", "month_name": "January"}


# Missing values


def sales(spark, rows):
    return spark.createDataFrame(
        rows,
        "`Invoice Date` string, City string, `Product Category` string, `Total Sales` double, id int",
    )


def test_share_of_an_empty_table_is_null(spark):
    empty = sales(spark, [])
    assert {r["share"] for r in missing.null_share(empty).collect()} == {None}
    assert missing.apply_policy(empty).count() == 0


def test_mode_ignores_nulls_and_breaks_ties_downwards(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert missing.modes(df, ["c"]) == {"c": "a"}
    assert {r.c for r in missing.fill_mode(df, "c").collect()} == {"a", "b"}
    nothing = spark.createDataFrame([(None,)], "c string")
    assert missing.fill_mode(nothing, "c").collect()[0].c is None


def test_policy_below_the_thresholds(spark):
    rows = [("1/1/2024", "x", "p", 1.0, i) for i in range(198)]
    rows += [(None, "x", "p", 1.0, 198), ("1/1/2024", None, None, 1.0, 199)]
    got = missing.apply_policy(sales(spark, rows)).collect()
    assert len(got) == 199
    assert {(r["City"], r["Product Category"]) for r in got} == {("x", "p")}


def test_policy_above_the_thresholds(spark):
    rows = [(f"1/{i + 1}/2024", "x", "p", 1.0, i) for i in range(8)]
    rows += [(None, None, None, 1.0, 8), ("1/20/2024", "y", "q", 1.0, 9)]
    got = {r.id: r for r in missing.apply_policy(sales(spark, rows), order_by=["id"]).collect()}
    assert got[8]["Invoice Date"] == "1/8/2024"
    assert got[8]["City"] == "Unknown" and got[8]["Product Category"] == "UnCategorized"


def test_forward_fill_needs_an_order(spark):
    rows = [(None, "x", "p", 1.0, 0), ("1/1/2024", "x", "p", 1.0, 1)]
    with pytest.raises(ValueError, match="order"):
        missing.apply_policy(sales(spark, rows))


def test_dropped_rows_do_not_count_for_later_columns(spark):
    # 1 of 40 dates is null. With that row 2 of 40 cities are null, without it 1 of 39:
    # both are at most 5 percent. Of the categories 1 of 40 would be above 1 percent, 0 of 39 is not.
    rows = [("1/1/2024", "x", "p", 1.0, i) for i in range(38)]
    rows += [(None, None, None, 1.0, 38), ("1/1/2024", None, "p", 1.0, 39)]
    shares = missing._shares(sales(spark, rows), ["Invoice Date", "City", "Product Category"], missing.default_policy())
    assert [(s.rows, s.nulls) for s in shares.values()] == [(40, 1), (39, 1), (39, 0)]
    # With the date last, the others are counted before its row is dropped.
    shares = missing._shares(sales(spark, rows), ["City", "Product Category", "Invoice Date"], missing.default_policy())
    assert [(s.rows, s.nulls) for s in shares.values()] == [(40, 2), (40, 1), (40, 1)]


def test_two_rules_that_drop(spark):
    policy = {"a": missing.DropOrForwardFill(60), "b": missing.DropOrForwardFill(60), "c": missing.ConstantOrMode(5, "z")}
    df = spark.createDataFrame(
        [(None, 1, "x"), (1, None, None), (1, 1, "x"), (1, 1, None)], "a int, b int, c string"
    )
    shares = missing._shares(df, ["a", "b", "c"], policy)
    assert [(s.rows, s.nulls) for s in shares.values()] == [(4, 1), (3, 1), (2, 1)]
    assert sorted(r.c for r in missing.apply_policy(df, policy).collect()) == ["x", "z"]


# Regression


def grid(spark, rows):
    return spark.createDataFrame(
        rows, "City string, `Product Category` string, `Total Sales` double"
    )


def test_regression_on_an_additive_grid(spark):
    rows = [("a", "p", 10.0), ("a", "q", 20.0), ("b", "p", 30.0), ("b", "q", None)]
    filled = regression.predict_missing_sales(grid(spark, rows)).collect()
    assert [r["Total Sales"] for r in filled if (r[0], r[1]) == ("b", "q")] == pytest.approx([40.0], rel=1e-6)
    assert len(filled) == 4


def test_regression_matches_least_squares_over_all_rows(spark):
    random = np.random.default_rng(1)
    cities, categories = random.integers(0, 7, 400), random.integers(0, 4, 400)
    truth = 100 * cities + 10 * categories + random.normal(0, 5, 400)
    empty = random.random(400) < 0.1
    rows = [
        (f"c{c}", f"k{k}", None if e else float(t))
        for c, k, t, e in zip(cities, categories, truth, empty)
    ]
    design = np.hstack([np.eye(7)[cities], np.eye(4)[categories]])
    weights = np.linalg.lstsq(design[~empty], truth[~empty], rcond=None)[0]
    wanted = {(f"c{c}", f"k{k}"): v for c, k, v in zip(cities, categories, design @ weights)}
    df = grid(spark, rows)
    model = regression.fit_sales_model(df)
    for row in regression.fill_with_model(df.where("`Total Sales` IS NULL"), model).collect():
        assert row[2] == pytest.approx(wanted[row[0], row[1]], rel=1e-6)


def test_regression_keeps_rows_of_unseen_categories(spark):
    rows = [("a", "p", 10.0), ("b", "q", 20.0), ("new", "p", None)]
    filled = regression.predict_missing_sales(grid(spark, rows)).collect()
    assert len(filled) == 3 and all(r["Total Sales"] is not None for r in filled)


def test_regression_without_nulls_or_without_sales_changes_nothing(spark):
    whole = grid(spark, [("a", "p", 1.0)])
    assert regression.predict_missing_sales(whole) is whole
    nothing = grid(spark, [("a", "p", None)])
    assert regression.predict_missing_sales(nothing) is nothing


def test_regression_keeps_decimals(spark):
    df = grid(spark, [("a", "p", 10.0), ("b", "p", 20.0), ("a", "p", None)]).withColumn(
        "Total Sales", F.col("`Total Sales`").cast("decimal(18,4)")
    )
    filled = regression.predict_missing_sales(df)
    assert dict(filled.dtypes)["Total Sales"] == "decimal(18,4)"


# Duplicates


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), (None, 2), (None, 2), ("b", 3)], "k string, count int")
    assert dedup.drop_duplicates(df).count() == 3
    assert dedup.drop_duplicates(dedup.drop_duplicates(df)).count() == 3
    assert dedup.drop_duplicates(df, ["k"]).count() == 3
    assert sorted(r.n_dup for r in dedup.duplicate_groups(df).collect()) == [2, 3]
    assert tuple(dedup.duplicate_counts(df).first()) == (2, 3)
    assert tuple(dedup.duplicate_counts(df.limit(0)).first()) == (0, 0)


# Outliers


def test_integers_are_capped_and_nulls_stay(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 1000, None)], "n int")
    low, high = outliers.collect_fences(outliers.iqr_fences(df))["n"]
    assert (low, high) == (2 - 1.5 * 2, 4 + 1.5 * 2)
    assert [r.n for r in outliers.handle_outliers(df).collect()] == [1.0, 2.0, 3.0, 4.0, 7.0, None]
    report = outliers.outlier_report(df, {"n": (low, high)}).first()
    assert (report["column"], report["outliers"]) == ("n", 1)


def test_column_without_values_has_null_fences(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    for method in ("exact", "approx"):
        fences = {r["column"]: r for r in outliers.iqr_fences(df, method=method).collect()}
        assert fences["b"]["lower"] is None and fences["a"]["lower"] is not None
    assert [r.b for r in outliers.handle_outliers(df).collect()] == [None, None]
    nothing = outliers.iqr_fences(df.select("b")).first()
    assert nothing["q1"] is None


def test_table_without_numbers_is_unchanged(spark):
    df = spark.createDataFrame([("x",)], "s string")
    assert outliers.handle_outliers(df) is df


def test_approximate_quantiles_are_close_in_rank(spark):
    df = spark.range(1, 10_001).select(F.col("id").cast("double").alias("v"))
    found = {r.p: r.value for r in outliers.quantiles_approx(df, ["v"], (0.25, 0.75), 100).collect()}
    assert abs(found[0.25] - 2500) <= 100 and abs(found[0.75] - 7500) <= 100


# Aggregates


def test_weekly_sums_and_summaries_agree(spark):
    df = spark.createDataFrame(
        [("1/1/2024", "a", "p", 1.5), ("01/07/2024", "a", "q", 2.5), ("1/8/2024", "b", "p", None), ("n/a", "b", "p", 4.0)],
        "`Invoice Date` string, City string, `Product Category` string, `Total Sales` double",
    )
    tables = aggregate.forecast_tables(df)
    assert {tuple(r) for r in tables.city_weekly.collect()} == {
        ("a", D(2024, 1, 1), 4.0),
        ("b", D(2024, 1, 8), None),
        ("b", None, 4.0),
    }
    direct = aggregate.sales_summary(df, "City").select(*tables.city_summary.columns)
    assert {tuple(r) for r in direct.collect()} == {tuple(r) for r in tables.city_summary.collect()}
    assert aggregate.sales_by_period(df, "City").columns == ["City", "Week Start", "City Week Sales"]


# Spine


def test_spine_without_gaps(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 3)), ("a", D(2024, 1, 24)), ("b", D(2024, 1, 3)), (None, D(2024, 1, 1)), (None, D(2024, 1, 15)), ("a", None)],
        "k string, `Week Start` date",
    )
    weeks = [r[1] for r in spine.spine(df, by=["k"]).where("k = 'a'").orderBy("Week Start").collect()]
    assert weeks == [D(2024, 1, 1) + datetime.timedelta(days=7 * i) for i in range(4)]
    gaps = {(r[0], r[1]) for r in spine.missing_periods(df, by=["k"]).collect()}
    assert gaps == {("a", D(2024, 1, 8)), ("a", D(2024, 1, 15)), (None, D(2024, 1, 8))}
    dense = spine.ensure_continuity(df, by=["k"])
    assert dense.where("is_missing").count() == 3 and dense.count() == 8
    assert spine.missing_periods(dense, by=["k"]).count() == 0


def test_gaps_of_the_whole_table(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 15))], "k string, `Week Start` date")
    assert [r[0] for r in spine.missing_periods(df).collect()] == [D(2024, 1, 8)]
    assert spine.spine(df.limit(0)).count() == 0


# Features


def series(spark, rows):
    return spark.createDataFrame(rows, "g string, `Week Start` date, s double")


def test_features_of_one_series(spark):
    weeks = [D(2024, 1, 1) + datetime.timedelta(days=7 * i) for i in range(4)]
    df = series(spark, [("a", w, float(v)) for w, v in zip(weeks, (10, 0, 30, 40))] + [("b", weeks[0], 5.0)])
    got = features.run_all(df, "g", "s", [1, 2], [2]).where("g = 'a'").orderBy("Week Start").collect()
    assert [r["s_lag1"] for r in got] == [None, 10.0, 0.0, 30.0]
    assert [r["s_rollmean2"] for r in got] == [None, 10.0, 5.0, 15.0]
    assert got[1]["s_rollstd2"] is None and got[2]["s_rollstd2"] == pytest.approx(50**0.5)
    assert [r["s_lag_diff1_2"] for r in got] == [None, None, -10.0, 30.0]
    assert [r["s_lag_ratio1_2"] for r in got] == [None, None, 0.0, None]  # 30 / 0
    eps = features.add_trend_features(features.add_lag_features(df, "g", "s", [1, 2]), "s", eps=1e-6)
    assert max(r["s_lag_ratio1_2"] or 0 for r in eps.collect()) == pytest.approx(30 / 1e-6)


def test_groups_do_not_leak(spark):
    df = series(spark, [("a", D(2024, 1, 1), 1.0), ("b", D(2024, 1, 8), 2.0)])
    got = features.add_rolling_features(df, "g", "s", [4]).collect()
    assert all(r["s_rollmean4"] is None for r in got)


def test_rows_without_a_week_are_no_ones_past(spark):
    df = series(spark, [("a", None, 99.0), ("a", D(2024, 1, 1), 1.0)])
    got = features.add_lag_features(df, "g", "s", [1]).where("`Week Start` IS NOT NULL").first()
    assert got["s_lag1"] is None


def test_densify_makes_lags_calendar_lags(spark):
    df = series(spark, [("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 15), 3.0)])
    rows = features.run_all(df, "g", "s", [1, 2], [1], densify=True).orderBy("Week Start").collect()
    assert [(r["s"], r["s_lag1"]) for r in rows] == [(1.0, None), (None, 1.0), (3.0, None)]


def test_add_all_uses_the_first_two_lags_and_names_what_is_missing(spark):
    df = series(spark, [("a", D(2024, 1, 1), 1.0)])
    columns = features.add_all(df, "g", "s", lags=[1, 3]).columns
    assert "s_lag_diff1_3" in columns and "s_lag1_x_month" in columns
    with pytest.raises(ValueError, match="s_lag1, s_lag2"):
        features.add_trend_features(df, "s")


# Profile and quality


def test_explore_returns_the_chosen_parts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, n int")
    assert list(profile.explore(df, nulls=True, value_counts=True)) == ["nulls", "value_counts"]
    parts = profile.explore(df, all=True)
    assert parts["overview"].first()["rows"] == 3
    assert tuple(parts["nulls"].first()) == (1, 0)
    counts = [tuple(r) for r in parts["value_counts"].collect()]
    assert counts == [("k", "a", 2), ("k", None, 1), ("n", "1", 2), ("n", "2", 1)]
    summary = parts["summary"].first()
    assert (summary["count"], summary["min"], summary["max"]) == (3, 1.0, 2.0)


def test_profile_without_numbers_or_without_text(spark):
    text = spark.createDataFrame([("b",), ("a",)], "k string")
    parts = profile.explore(text, summary=True)
    assert parts["summary"].count() == 0
    assert tuple(parts["text_summary"].first()) == ("k", 2, "a", "b")
    assert profile.explore(spark.range(2), all=True)["text_summary"].count() == 0


def test_quality_report(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 1), "a", "p", Decimal("1")), (D(2024, 1, 1), "a", "p", Decimal("1")), (D(2024, 1, 15), "b", None, Decimal("-2"))],
        "`Invoice Date` date, City string, `Product Category` string, `Total Sales` decimal(18,4)",
    )
    got = {(r["check"], r["subject"]): (r["value"], r["status"]) for r in quality.quality_report(df).collect()}
    assert got["rows", "table"] == (3, "info")
    assert got["nulls", "Product Category"] == (1, "failed")
    assert got["not positive", "Total Sales"] == (1, "failed")
    assert got["surplus duplicates", "table"] == (1, "failed")
    assert got["missing weeks", "Invoice Date"] == (1, "failed")
    assert got["type differs", "Invoice Date"] == (0, "ok")
    details = quality.run_quality_checks(df, seed=1)
    assert details.nonpositive.count() == 1 and details.sample.count() == 3


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    assert ranking.random_sample(df, 10, 3).collect() == ranking.random_sample(df, 10, 3).collect()
    assert ranking.random_sample(df, 10).count() == 10


# Cleaning


def test_clean_in_the_usual_order(spark):
    rows = [("i1", "1/1/2024", " A* ", "P", 1.0), ("i2", "1/1/2024", " A* ", "P", 1.0), ("i3", "1/1/2024", "a", "P", 1.0)]
    df = spark.createDataFrame(
        rows, "`Invoice ID` string, `Invoice Date` string, City string, `Product Category` string, `Total Sales` double"
    )
    # Equal once the id is gone; untidy text is not equal yet when duplicates are dropped.
    assert [tuple(r) for r in clean(df).collect()] == [("1/1/2024", "a", "p", 1.0)] * 2
    assert clean(df, dedup_keys=["Invoice Date"]).count() == 1


# Round 2: exact caps, reports without rows, rejects, solvers


def test_capping_keeps_types_and_digits(spark):
    import decimal

    rows = [(decimal.Decimal("12345678901234.5678"), 2**53 + 1, 1.5), (decimal.Decimal("1.0000"), 5, None), (None, None, 900.0)]
    df = spark.createDataFrame(rows, "d decimal(18,4), i bigint, f float")
    capped = outliers.cap_outliers(df, {"d": (0.0, 1e16), "i": (6.5, 1e30), "f": (2.0, 100.25)})
    assert capped.schema == df.schema
    got = capped.collect()
    assert [r.d for r in got] == [r[0] for r in rows]
    assert [r.i for r in got] == [2**53 + 1, 7, None]
    assert [r.f for r in got] == [2.0, None, 100.25]
    assert outliers.cap_outliers(df, {"d": (0.0, 99.9)}).first().d == decimal.Decimal("99.9")


def test_reports_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "`Invoice Date` date, City string, `Product Category` string, `Total Sales` decimal(18,4)")
    checked = schema.type_check(empty, quality.expected_types())
    assert all(r.ok and r.rejected == 0 and r.expected == r.actual for r in checked.collect())
    assert profile.overview(empty).first().names.startswith("Invoice Date")
    report = quality.quality_report(empty).collect()
    assert {r.status for r in report if r.check == "type differs"} == {"ok"}
    assert outliers.outlier_report(empty, {"Total Sales": (0.0, 1.0)}).first().lower == 0.0


def test_bare_year_is_no_date(spark):
    rows = [("2024",), ("2024-03-05",), ("3/5/2024",), ("2024-03",), (None,)]
    df = spark.createDataFrame(rows, "d string")
    got = [r[0] for r in df.select(dates.as_date(F.col("d"), df.schema["d"].dataType)).collect()]
    assert [g is not None for g in got] == [False, True, True, False, False]


def test_text_sales_are_cast_before_they_are_filled(spark):
    from weekloom.columns import SalesColumns
    from weekloom.plans.clean import clean

    names = SalesColumns("d", "c", "k", "s", "w")
    rows = [("1/1/2024", c, k, "n/a" if i == 3 else None if i == 5 else str(10 * i)) for i, (c, k) in enumerate([("a", "x"), ("b", "x"), ("a", "y"), ("b", "y")] * 3)]
    df = spark.createDataFrame(rows, "d string, c string, k string, s string")
    cleaned = clean(df, names, [])
    assert cleaned.where("s is null").count() == 0 and dict(cleaned.dtypes)["s"] == "decimal(18,4)"
    rejected = {(r.check, r.subject): r.value for r in quality.rejects(df, names).collect()}
    assert rejected == {("rejected", "d"): 0, ("rejected", "s"): 1, ("rounded", "s"): 0}


def test_solver_has_stated_limits(spark):
    df = spark.range(5_000).select(F.col("id").cast("string").alias("c"), F.col("id").cast("double").alias("s"))
    with pytest.raises(ValueError, match="5000 categories"):
        regression.fit_sales_model(df, "s", ["c"], solver="normal")
    with pytest.raises(RuntimeError, match="did not converge"):
        regression.fit_sales_model(df.limit(300), "s", ["c"], solver="l-bfgs", max_iter=1)


def test_densified_days_stay_days(spark):
    rows = [("a", f"2024-01-0{d}", float(d)) for d in (1, 2, 5)]
    df = spark.createDataFrame(rows, "g string, day string, v double").withColumn("day", F.col("day").cast("date"))
    got = features.run_all(df, "g", "v", [1, 2], [2], "day", densify=True, grain="day").orderBy("day").collect()
    assert [str(r.day)[-2:] for r in got] == ["01", "02", "03", "04", "05"] and [r.v_lag1 for r in got][1:3] == [1.0, 2.0]


def test_top_values(spark):
    df = spark.range(1_000).select(F.least(F.col("id") % 7, F.lit(3)).alias("a"), F.col("id").alias("b"))
    got = profile.value_counts(df, top=2).orderBy("column", F.desc("n"), "value").collect()
    assert [(r.column, r.value) for r in got] == [("a", "3"), ("a", "0"), ("b", "0"), ("b", "1")]
