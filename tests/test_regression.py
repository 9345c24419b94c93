"""Category indexing and least squares for any number of categories."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.operators import indexing, least_squares, missing, regression
from weekloom.operators.indexing import category_index, dense_numbers, index_categories, join_by_value


def test_dense_numbers_follow_the_order(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("v"), F.lit("kept").alias("place"))
    got = dense_numbers(df.repartition(6), [F.desc("v")], "n")
    assert got.columns == ["v", "place", "n"]
    assert got.where(F.col("n") != 4_999 - F.col("v")).count() == 0 and got.select("n").distinct().count() == 5_000
    assert dense_numbers(df.limit(0), [F.col("v")]).count() == 0


def test_category_index_by_frequency_and_by_value(spark):
    rows = [("b",), ("b",), ("a",), ("c",), ("c",), (None,)]
    df = spark.createDataFrame(rows, "k string").withColumn("n", F.when(F.col("k") == "b", 5).otherwise(7))
    got = {(r["column"], r["value"]): (r["n"], r["id"]) for r in category_index(df, ["k", "n"]).collect()}
    assert got == {("k", "b"): (2, 0), ("k", "c"): (2, 1), ("k", "a"): (1, 2), ("n", "7"): (4, 0), ("n", "5"): (2, 1)}
    by_value = category_index(df, ["k"], order="value")
    assert [r["value"] for r in by_value.orderBy("id").collect()] == ["a", "b", "c"]
    indexed = index_categories(df, ["k"])
    assert sorted(map(tuple, indexed.select("k", "k Index").distinct().collect()), key=str) == [
        ("a", 2), ("b", 0), ("c", 1), (None, None),
    ]


def test_many_labels_get_dense_ids(spark):
    df = spark.range(400_000).select(F.concat(F.lit("label "), F.col("id") % 200_000).alias("c"))
    found = category_index(df, ["c"]).agg(F.count("*"), F.min("id"), F.max("id"), F.count_distinct("id"), F.min("n"), F.max("n")).first()
    assert tuple(found) == (200_000, 0, 199_999, 200_000, 2, 2)


def test_hot_value_is_dealt_to_parts(spark, monkeypatch):
    monkeypatch.setattr(indexing, "SALT_ROWS", 10)
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("c"), F.col("id").alias("part"))
    lookup = df.where("c is not null").select(F.col("c").alias("value"), F.concat(F.lit("of "), "c").alias("name")).distinct()
    got = join_by_value(df, lookup, F.col("c"))
    assert got.columns == ["c", "part", "name"] and got.count() == 300
    assert got.where(~F.col("name").eqNullSafe(F.concat(F.lit("of "), "c"))).count() == 0


def _noisy(seed, cities, categories, rows):
    random = np.random.default_rng(seed)
    c, k = random.integers(0, cities, rows), random.integers(0, categories, rows)
    y = 1000 + 30 * random.normal(size=cities)[c] + 200 * random.normal(size=categories)[k] + random.normal(0, 5, rows)
    return c, k, y, random.random(rows) < 0.1


@pytest.mark.parametrize("parts", [100_000, 3])
def test_effects_are_those_of_least_squares(spark, monkeypatch, parts):
    monkeypatch.setattr(least_squares, "CELLS_PER_PART", parts)
    c, k, y, empty = _noisy(3, 120, 15, 3_000)
    design = np.hstack([np.eye(120)[c], np.eye(15)[k]])
    weights = np.linalg.lstsq(design[~empty], y[~empty], rcond=None)[0]
    wanted = (design @ weights)[empty]
    rows = [(int(i), None if a == 7 else f"c{a}", int(b), None if e else float(v)) for i, (a, b, v, e) in enumerate(zip(c, k, y, empty))]
    df = spark.createDataFrame(rows, "id long, city string, category int, sales double")
    filled = regression.predict_missing_sales(df, "sales", ["city", "category"], solver="cells")
    assert filled.columns == df.columns and filled.count() == 3_000
    got = filled.where(F.col("id").isin([int(i) for i in np.flatnonzero(empty)])).orderBy("id").toPandas()
    np.testing.assert_allclose(got["sales"], wanted, rtol=1e-8)


def test_three_features_and_unseen_categories(spark):
    rows = [(a, b, c, float(10 * a + 100 * b + c)) for a in range(4) for b in range(3) for c in range(2)]
    df = spark.createDataFrame([*rows, (9, 1, 1, None), (2, None, 0, None)], "a int, b int, c int, y double")
    filled = regression.predict_missing_sales(df, "y", ["a", "b", "c"], solver="cells")
    got = {(r.a, r.b): r.y for r in filled.where("a = 9 or b is null").collect()}
    # An unknown category counts as the average one.
    assert got == {(9, 1): pytest.approx(15 + 100 + 1), (2, None): pytest.approx(20 + 100 + 0)}


def test_policy_fills_a_table_with_more_categories_than_the_normal_equations_take(spark):
    shop = spark.range(27_000).select(
        F.concat(F.lit("city "), F.col("id") % 4_500).alias("City"),
        F.concat(F.lit("kind "), F.col("id") % 7).alias("Product Category"),
        F.lit("2024-01-01").alias("Invoice Date"),
        F.when(F.col("id") % 47 != 0, (F.col("id") % 4_500) * 10.0 + F.col("id") % 7).alias("Total Sales"),
        (F.col("id") % 4_500 * 10.0 + F.col("id") % 7).alias("truth"),
    )
    filled = missing.apply_policy(shop)
    assert filled.columns == shop.columns and filled.count() == 27_000
    off = F.abs(F.col("Total Sales") - F.col("truth")) > 1e-6 * F.greatest(F.lit(1.0), F.col("truth"))
    assert filled.where(F.col("Total Sales").isNull() | off).count() == 0


def test_the_rule_names_the_solver(spark):
    df = spark.createDataFrame([("a", "p", 1.0), ("b", "p", None)], "City string, k string, s double")
    policy = {"s": missing.Regression(("City", "k"), solver="l-bfgs")}
    assert missing.apply_policy(df, policy).where("s is null").count() == 0


def test_input_columns_keep_their_values_whatever_their_names(spark):
    rows = [("a", "p", 10.0, 1), ("b", "p", 20.0, 2), ("a", "p", None, 3)]
    df = spark.createDataFrame(rows, "City string, `Product Category` string, `Total Sales` double, __guess int")
    for name in ("__index_0", "__vector_1", "__features", "__label", "key", "row"):
        df = df.withColumn(name, F.lit(7))
    for solver in ("normal", "cells"):
        filled = regression.predict_missing_sales(df, solver=solver)
        assert filled.columns == df.columns
        assert sorted((r["__guess"], r["Total Sales"], r["__features"], r["row"]) for r in filled.collect()) == [
            (1, 10.0, 7, 7), (2, 20.0, 7, 7), (3, pytest.approx(10.0), 7, 7),
        ]


def test_no_convergence_raises(spark):
    c, k, y, _ = _noisy(4, 40, 9, 400)
    df = spark.createDataFrame([(f"{a}", f"{b}", float(v)) for a, b, v in zip(c, k, y)], "a string, b string, s double")
    with pytest.raises(RuntimeError, match="did not converge"):
        regression.fit_sales_model(df, "s", ["a", "b"], solver="cells", max_iter=2)


def test_cells_do_not_move_in_an_iteration(spark, monkeypatch):
    """Only the directions are shuffled: neither to a bucketed feature nor to a small one do the cells go."""
    from weekloom.operators import least_squares

    monkeypatch.setattr(least_squares, "MOST_BROADCAST", 50)
    plans = []
    kept = least_squares.materialise

    def noted(df, label):
        if label == "conjugate-step":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, label)

    monkeypatch.setattr(least_squares, "materialise", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = spark.range(4_000).select(
            (F.col("id") % 400).alias("part"), (F.col("id") % 7).alias("city"), (F.col("id") % 400 + 10 * (F.col("id") % 7)).cast("double").alias("y"), F.lit(1.0).alias("w")
        )
        cells = cells.groupBy("part", "city").agg(F.avg("y").alias("y"), F.sum("w").alias("w"))
        model = least_squares.fit_category_effects(cells, ["part", "city"], "y", "w")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans and all("SortMergeJoin" in p and "BroadcastHashJoin" in p for p in plans)
    scans = [line for p in plans for line in p.splitlines() if "Scan parquet" in line and "j0#" in line and "j1#" in line]
    assert scans and all("Bucketed: true" in line for line in scans)
    for p in plans:
        lines = p.splitlines()
        scan = next(k for k, line in enumerate(lines) if "Bucketed: true" in line)
        above = lines[: scan]
        join = max(k for k, line in enumerate(above) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in above[join:])
    got = least_squares.predicted(cells, model).select("row.y", "guess").collect()
    assert all(abs(r.y - r.guess) < 1e-6 for r in got)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("weekloom")]
