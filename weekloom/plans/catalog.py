"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions import dates, text
from weekloom.functions.numbers import total
from weekloom.operators import (
    aggregate,
    dedup,
    features,
    indexing,
    missing,
    outliers,
    profile,
    quality,
    ranking,
    regression,
    schema,
    sketches,
    spine,
)
from weekloom.operators.forward_fill import forward_fill
from weekloom.plans.clean import clean
from weekloom.plans.views import KEY, NAMES, dirty, sales, table
from weekloom.plans.wrangle import build_features, wrangle
from weekloom.shared import materialise, shared_folder
from weekloom.sinks import export_features, export_version
from weekloom.sources import load_data, read_folder, read_latest
from weekloom.streaming import ingest_new_files, weekly

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CITY_SALES, CATEGORY_SALES = "City Weekly Sales", "Category Weekly Sales"
SALES_SCHEMA = "invoice_date date, city string, category string, total_sales decimal(18,4)"
WEEK = NAMES.week


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _facts(spark, folder):
    """The four columns every aggregate needs."""
    return sales(spark, folder, ("invoice_date", "city", "category", "total_sales"))


def _weekly(spark, folder, key="category", out=CATEGORY_SALES):
    rows = sales(spark, folder, ("invoice_date", key, "total_sales"))
    return aggregate.sales_by_period(rows, key, "invoice_date", "total_sales", period=WEEK, out=out)


def _landed(spark, folder, columns):
    """The raw view as a stored table, as a raw file would be.

    For steps that look at their input several times, so that the lookups behind
    the view are joined once.
    """
    return materialise(dirty(spark, folder, columns), "raw-sales")


def _totals(df, *keys, sales_column="total_sales"):
    """Row count and exact sales per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), total(F.col(sales_column)).alias("sales")
    )


# Sources and sinks


@query
def scan_parquet(spark, folder):
    orders = load_data(spark, f"{folder}/orders.parquet", "parquet")
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        total(F.col("o_totalprice").cast("decimal(12,2)")).alias("price"),
        F.max(F.col("o_orderdate").cast("date")).alias("last_date"),
    )


@query
def scan_csv_roundtrip(spark, folder):
    path = shared_folder(spark, "sales-csv")
    _facts(spark, folder).write.csv(path, header=True)
    return _totals(load_data(spark, path, "csv", SALES_SCHEMA), "city", "category")


@query
def scan_csv_inferred(spark, folder):
    path = shared_folder(spark, "orders-csv")
    table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.csv(
        path, header=True
    )
    return (
        load_data(spark, path)
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    )


@query
def export_then_read_latest(spark, folder):
    target = shared_folder(spark, "versions")
    daily = aggregate.sales_by_period(
        _facts(spark, folder), "city", "invoice_date", "total_sales", "day", WEEK, CITY_SALES
    )
    export_version(daily, target, "city_sales_weekly", "csv")
    export_version(_weekly(spark, folder, "city", CITY_SALES), target, "city_sales_weekly", order_by=[WEEK])
    return read_latest(spark, target, "city_sales_weekly")


@query
def export_features_then_read(spark, folder):
    target = shared_folder(spark, "features")
    weekly = _weekly(spark, folder)
    export_version(weekly, target, "category_sales_weekly")
    lagged = features.add_lag_features(weekly, "category", CATEGORY_SALES, [1], WEEK)
    export_features(target, city=_weekly(spark, folder, "city", CITY_SALES), category=lagged)
    return read_latest(spark, target, "category_sales_weekly_features")


def _yearly_files(spark, folder):
    path = shared_folder(spark, "arriving")
    rows = _facts(spark, folder).withColumn("year", F.year("invoice_date"))
    rows.write.partitionBy("year").csv(path, header=True)
    return path


@query
def folder_ingest(spark, folder):
    path = _yearly_files(spark, folder)
    return _totals(read_folder(spark, path, "csv", SALES_SCHEMA), "category")


@query
def folder_ingest_incremental(spark, folder):
    path = _yearly_files(spark, folder)
    target, state = shared_folder(spark, "ingested"), shared_folder(spark, "ingest-state")
    ingest_new_files(spark, path, target, state, SALES_SCHEMA)
    # A second run finds nothing new and must not repeat a file.
    return _totals(ingest_new_files(spark, path, target, state, SALES_SCHEMA), "category")


@query
def weekly_tables_from_files(spark, folder):
    """Weekly city summaries kept up to date in batches of two files, folded half way, and run again without news."""
    path = shared_folder(spark, "arriving-dates")
    rows = _facts(spark, folder).withColumn("invoice_date", F.date_format("invoice_date", "MM/dd/yyyy"))
    rows.withColumn("year", F.substring("invoice_date", -4, 4)).write.partitionBy("year").csv(path, header=True)
    cells, state = shared_folder(spark, "cells"), shared_folder(spark, "cells-state")
    raw = "invoice_date string, city string, category string, total_sales string"
    weekly.update_cells(spark, path, cells, state, raw, NAMES, files_per_batch=2)
    weekly.compact(spark, cells, NAMES)
    weekly.update_cells(spark, path, cells, state, raw, NAMES)
    return weekly.stored_tables(spark, cells, NAMES).city_summary.select(
        WEEK, "city", F.col("Total Sales").alias("sales"), F.col("Average Sales").alias("average"), F.col("Transaction Count").alias("n")
    )


# Columns, types and predicates


@query
def drop_and_cast(spark, folder):
    rows = dirty(spark, folder, ["invoice_id", "invoice_date", "city", "category", "total_sales", "quantity"])
    typed = schema.coerce_types(
        schema.drop_columns(rows, ["invoice_id", "not_there"]), {**NAMES.required, "quantity": "int"}
    )
    return typed.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("invoice_date").alias("dates"),
        total(F.col("total_sales")).alias("sales"),
        F.sum("quantity").alias("pieces"),
        F.any_value(F.lit(len(typed.columns))).alias("n_columns"),
    )


@query
def rename_columns(spark, folder):
    rows = schema.rename(_facts(spark, folder), {"city": "City", "total_sales": "Total Sales"})
    return rows.groupBy("City").agg(total(F.col("`Total Sales`")).alias("City Sales"))


@query
def schema_report(spark, folder):
    return schema.schema_report(
        sales(spark, folder, ("invoice_date", "city", "category", "total_sales", "quantity"))
    )


@query
def type_check(spark, folder):
    return schema.type_check(
        dirty(spark, folder, ["invoice_date", "city", "category", "total_sales"]), quality.expected_types(NAMES)
    )


@query
def numeric_columns(spark, folder):
    orders = table(spark, folder, "orders")
    return schema.aggregate_columns(
        orders, {c: {"filled": F.count(c), "largest": F.max(F.col(c).cast("double"))} for c in schema.numeric_columns(orders)}
    )


@query
def nonpositive_sales(spark, folder):
    balances = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return quality.nonpositive_sales(balances, "c_acctbal")


@query
def null_rows(spark, folder):
    rows = dirty(spark, folder, ["city", "category_hi", "total_sales"])
    empty = _totals(schema.null_rows(rows, "city"), "category_hi").withColumn("city_is_null", F.lit(True))
    filled = _totals(schema.filled_rows(rows, "city"), "category_hi").withColumn("city_is_null", F.lit(False))
    return schema.stack_rows([empty, filled])


@query
def drop_null_rows(spark, folder):
    rows = dirty(spark, folder, ["city", "category_hi", "total_sales"])
    return _totals(schema.drop_null_rows(rows, ["city", "total_sales"]), "category_hi")


@query
def distinct_values(spark, folder):
    return profile.distinct_values(sales(spark, folder, ("city",)), "city")


@query
def distinct_counts(spark, folder):
    columns = ("city", "category", "quantity")
    return profile.distinct_counts(sales(spark, folder, columns), columns)


@query
def distinct_counts_approx(spark, folder):
    """Whether each estimate is within three standard errors (1.6 % each) of the number."""
    columns = ("city", "category", "quantity")
    rows = sales(spark, folder, columns)
    found = profile.distinct_counts(rows).withColumnRenamed("n_distinct", "estimate")
    joined = found.join(profile.distinct_counts(rows, columns), "column")
    close = F.abs(F.col("estimate") - F.col("n_distinct")) <= F.greatest(F.lit(1), 0.05 * F.col("n_distinct"))
    return joined.select("column", close.alias("close"))


@query
def distinct_counts_from_days(spark, folder):
    """Sketches per day, stored, and merged per year: exact row counts, and estimates next to the numbers."""
    rows = _landed(spark, folder, ["date_hi", "city_hi", "invoice_id"])
    columns = ["city_hi", "invoice_id"]
    daily = materialise(sketches.column_sketches(rows, columns, ["date_hi"]), "daily-sketches")
    year = F.year("date_hi")
    yearly = sketches.distinct_estimates(sketches.merge_sketches(daily, [year.alias("year")]))
    exact = rows.groupBy(year.alias("year")).agg(*[F.count_distinct(c).alias(c) for c in columns])
    exact = exact.unpivot("year", columns, "column", "n_distinct").withColumnRenamed("year", "of")
    close = F.abs(yearly.n_distinct - exact.n_distinct) <= F.greatest(F.lit(1), 0.05 * exact.n_distinct)
    matched = yearly.join(exact, yearly.year.eqNullSafe(F.col("of")) & (yearly["column"] == exact["column"]))
    return matched.select(yearly.year, yearly["column"], "rows", "filled", exact.n_distinct, close.alias("close"))


@query
def quantiles_from_days(spark, folder):
    """Quantile sketches per day merged per year: how far each is off, in ranks, against one percent."""
    rows = _landed(spark, folder, ["date_hi", "total_sales"])
    daily = materialise(sketches.column_sketches(rows, ["total_sales"], ["date_hi"]), "daily-sketches")
    year = F.year("date_hi").alias("year")
    yearly = sketches.quantile_estimates(sketches.merge_sketches(daily, [year]), [0.05, 0.25, 0.5, 0.75, 0.95])
    sales_of = rows.select(year, F.col("total_sales").cast("double").alias("sale"))
    number = F.col("sale").isNotNull()
    ranked = yearly.withColumnRenamed("year", "of").join(sales_of, F.col("of").eqNullSafe(F.col("year")))
    below, upto = F.count_if(number & (F.col("sale") < F.col("value"))), F.count_if(number & (F.col("sale") <= F.col("value")))
    n = F.count("sale")
    close = (below <= (F.col("p") + 0.01) * n) & (upto >= (F.col("p") - 0.01) * n)
    return ranked.groupBy("year", "p").agg(F.max("rows").alias("rows"), n.alias("filled"), close.alias("close"))


@query
def union_by_name(spark, folder):
    rows = dirty(spark, folder, ["city_hi", "category_hi", "total_sales", "full_sales"])
    empty = schema.null_rows(rows, "total_sales").select("full_sales", "category_hi", "city_hi")
    filled = schema.filled_rows(rows, "total_sales").select("city_hi", "category_hi", "full_sales")
    return _totals(schema.stack_rows([filled, empty]), "city_hi", "category_hi", sales_column="full_sales")


# Missing values


@query
def null_share(spark, folder):
    return missing.null_share(dirty(spark, folder))


@query
def null_counts(spark, folder):
    return missing.null_counts(dirty(spark, folder))


def _treated(spark, folder, columns, policy, order_by=()):
    rows = _landed(spark, folder, [*columns, "full_sales"])
    return missing.apply_policy(rows, policy, order_by)


@query
def date_policy_drop(spark, folder):
    policy = {"invoice_date": missing.DropOrForwardFill(5)}
    left = _treated(spark, folder, ["invoice_date", "category_hi"], policy)
    return _totals(left, "category_hi", sales_column="full_sales")


@query
def date_policy_fill(spark, folder):
    policy = {"date_hi": missing.DropOrForwardFill(5)}
    filled = _treated(spark, folder, [*KEY, "date_hi"], policy, KEY)
    return _totals(filled, "date_hi", sales_column="full_sales")


def _filled_checks(filled):
    """Which rows got which date, in few result rows."""
    return filled.groupBy("date_hi").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_orderkey").alias("orders"),
        F.sum(F.col("l_partkey") * F.col("l_linenumber")).alias("parts"),
    )


@query
def forward_fill_all(spark, folder):
    return _filled_checks(forward_fill(_landed(spark, folder, [*KEY, "date_hi"]), "date_hi", KEY))


@query
def forward_fill_by_key(spark, folder):
    rows = _landed(spark, folder, [*KEY, "category_hi", "date_hi"])
    return _filled_checks(forward_fill(rows, "date_hi", KEY, ["category_hi"]))


@query
def constant_fill(spark, folder):
    policy = {
        "city_hi": missing.ConstantOrMode(5, "Unknown"),
        "category_hi": missing.ConstantOrMode(1, "UnCategorized"),
    }
    filled = _treated(spark, folder, ["city_hi", "category_hi"], policy)
    return _totals(filled, "city_hi", "category_hi", sales_column="full_sales")


@query
def mode_fill(spark, folder):
    policy = {
        "city": missing.ConstantOrMode(5, "Unknown"),
        "category": missing.ConstantOrMode(1, "UnCategorized"),
    }
    filled = _treated(spark, folder, ["city", "category"], policy)
    return _totals(filled, "city", "category", sales_column="full_sales")


@query
def regression_impute(spark, folder):
    rows = _landed(spark, folder, ["city_hi", "category_hi", "total_sales"])
    filled = regression.predict_missing_sales(rows, "total_sales", ["city_hi", "category_hi"])
    return _totals(filled, "city_hi", "category_hi")


@query
def regression_many_categories(spark, folder):
    """Parts and cities as features: too many categories for normal equations on larger tables."""
    rows = _landed(spark, folder, [*KEY, "city_hi", "total_sales"])
    hit = F.col("total_sales").isNull()
    rows = rows.withColumns({"was_null": hit, "total_sales": F.col("total_sales").cast("double")})
    filled = regression.predict_missing_sales(rows, "total_sales", ["l_partkey", "city_hi"], solver="cells")
    return filled.where("was_null").groupBy("city_hi").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("total_sales"), 2).alias("average")
    )


@query
def category_index(spark, folder):
    rows = dirty(spark, folder, ["city_hi", "l_partkey", "invoice_id"])
    return indexing.category_index(rows, ["city_hi", "l_partkey", "invoice_id"])


@query
def indexed_rows(spark, folder):
    """Every row with the indices of its categories, summed up per city."""
    rows = dirty(spark, folder, ["city_hi", "l_partkey"])
    indexed = indexing.index_categories(rows, ["city_hi", "l_partkey"])
    return indexed.groupBy("city_hi", "city_hi Index").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_partkey Index").alias("parts")
    )


def _raw_sales(spark, folder):
    """Raw rows without null sales, so that no model is involved."""
    rows = _landed(
        spark, folder, ["invoice_id", "invoice_date", "city", "category", "full_sales", "quantity"]
    )
    return schema.rename(rows, {"full_sales": "total_sales"})


@query
def clean_sales(spark, folder):
    cleaned = clean(_raw_sales(spark, folder), NAMES, ["invoice_id"])
    return cleaned.groupBy("city", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("invoice_date").alias("dates"),
        total(F.col("total_sales")).alias("sales"),
        F.sum("quantity").alias("pieces"),
    )


@query
def clean_sales_many_nulls(spark, folder):
    rows = _landed(
        spark, folder, ["invoice_id", *KEY, "date_hi", "city_hi", "category_hi", "full_sales", "quantity"]
    )
    raw = schema.rename(
        rows,
        {
            "date_hi": "invoice_date",
            "city_hi": "city",
            "category_hi": "category",
            "full_sales": "total_sales",
        },
    )
    cleaned = clean(raw, NAMES, ["invoice_id", *KEY], order_by=KEY)
    return cleaned.groupBy("city", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("invoice_date").alias("dates"),
        total(F.col("total_sales")).alias("sales"),
        F.sum("quantity").alias("pieces"),
    )


# Duplicates and outliers


@query
def drop_duplicates(spark, folder):
    rows = dirty(spark, folder, [*KEY, "city_hi", "category_hi", "date_hi", "total_sales"])
    return _totals(dedup.drop_duplicates(rows), "city_hi", "category_hi")


@query
def duplicate_groups(spark, folder):
    rows = dirty(spark, folder, [*KEY, "city_hi", "category_hi", "date_hi"])
    return dedup.duplicate_groups(rows)


@query
def duplicate_surplus(spark, folder):
    return dedup.duplicate_counts(dirty(spark, folder))


@query
def quartiles_exact(spark, folder):
    return outliers.iqr_fences(sales(spark, folder, ("total_sales", "quantity")))


@query
def quartiles_approx(spark, folder):
    """Whether each estimate's rank is off by no more than the accuracy allows, over all rows."""
    rows = sales(spark, folder, ("total_sales", "quantity"))
    found = outliers.quantiles_approx(rows, ["total_sales", "quantity"]).collect()
    measures = {}
    for r in found:
        value, p = F.col(r["column"]).cast("double"), F.lit(r["p"])
        # One row more, as ranks are whole numbers.
        slack = 1 / outliers.APPROXIMATE_ACCURACY + 1 / F.count(F.lit(1))
        below, upto = F.avg((value < r["value"]).cast("int")), F.avg((value <= r["value"]).cast("int"))
        measures[f"{r['column']} {r['p']}"] = {"close": (below <= p + slack) & (upto >= p - slack)}
    return schema.aggregate_columns(rows, measures, "quantile")


def _values(spark, folder):
    return table(spark, folder, "events").select("event_type", "value")


@query
def outlier_report(spark, folder):
    values = _values(spark, folder)
    return outliers.outlier_report(values, outliers.collect_fences(outliers.iqr_fences(values)))


@query
def cap_outliers(spark, folder):
    capped = outliers.handle_outliers(_values(spark, folder))
    return capped.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
        total(F.col("value").cast("decimal(22,8)")).alias("total"),
    )


@query
def cap_with_nan(spark, folder):
    """Every seventh value is NaN: it moves no fence and is not capped."""
    values = table(spark, folder, "events").select("event_type", "event_id", "value")
    spoilt = values.withColumn("value", F.when(F.col("event_id") % 7 == 0, float("nan")).otherwise(F.col("value")))
    capped = outliers.handle_outliers(spoilt, ["value"])
    return capped.groupBy("event_type").agg(
        F.count_if(F.isnan("value")).alias("n_nan"),
        F.min("value").alias("lowest"),
        F.max(F.nanvl("value", F.lit(None).cast("double"))).alias("highest"),
        total(F.nanvl("value", F.lit(None).cast("double")).cast("decimal(22,8)")).alias("total"),
    )


@query
def cap_integer_outliers(spark, folder):
    lengths = table(spark, folder, "documents").select("lang", "n_chars")
    capped = outliers.handle_outliers(lengths)
    return capped.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("n_chars").alias("highest"),
        F.sum("n_chars").alias("total"),
    )


# Scalar functions


@query
def normalise_text(spark, folder):
    cities = dirty(spark, folder, ["city"]).select(text.tidy(F.col("city")).alias("name"))
    sources = table(spark, folder, "documents").select(
        text.tidy(F.concat(F.lit("  "), F.upper("source"), F.lit(" (é)* "))).alias("name")
    )
    return cities.unionByName(sources).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query
def normalise_documents(spark, folder):
    """Whole texts: every character of every document passes the filter."""
    tidy = text.tidy(F.col("text"), all_whitespace=True, retrim=True)
    return table(spark, folder, "documents").select("doc_id", F.md5(tidy).alias("tidy_md5"))


@query
def parse_dates(spark, folder):
    rows = dirty(spark, folder, ["invoice_date"])
    parsed = rows.withColumn("day", dates.parse_date(F.col("invoice_date")))
    return parsed.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"),
        schema.rejected(F.col("invoice_date"), F.col("day")).alias("rejected"),
    )


@query
def week_starts(spark, folder):
    rows = sales(spark, folder, ("invoice_date",))
    return rows.groupBy(dates.week_start(F.col("invoice_date")).alias(WEEK)).agg(
        F.count(F.lit(1)).alias("n"), F.min("invoice_date").alias("first_date")
    )


@query
def date_parts(spark, folder):
    days = sales(spark, folder, ("invoice_date",)).distinct()
    return features.add_date_parts(days, "invoice_date").withColumn(
        "iso_year", dates.iso_year(F.col("invoice_date")).cast("int")
    )


@query
def date_names(spark, folder):
    days = sales(spark, folder, ("invoice_date",)).distinct()
    return days.withColumns(dates.date_names(F.col("invoice_date")))


# Aggregates


@query
def weekly_city_sales(spark, folder):
    return _weekly(spark, folder, "city", CITY_SALES)


@query
def weekly_category_sales(spark, folder):
    return _weekly(spark, folder)


def _summary(spark, folder, key, grain="week"):
    rows = sales(spark, folder, ("invoice_date", key, "total_sales"))
    return aggregate.sales_summary(rows, key, "invoice_date", "total_sales", grain, WEEK)


@query
def weekly_city_summary(spark, folder):
    return _summary(spark, folder, "city")


@query
def weekly_category_summary(spark, folder):
    return _summary(spark, folder, "category")


@query
def daily_sales(spark, folder):
    return _summary(spark, folder, "category", "day")


@query
def monthly_sales(spark, folder):
    return _summary(spark, folder, "city", "month")


@query
def forecast_tables(spark, folder):
    made = aggregate.forecast_tables(_facts(spark, folder), NAMES)
    named = {
        "city": made.city_weekly.withColumnsRenamed({"city": "key", CITY_SALES: "Total Sales"}),
        "category": made.category_weekly.withColumnsRenamed({"category": "key", CATEGORY_SALES: "Total Sales"}),
        "city summary": made.city_summary.withColumnRenamed("city", "key"),
        "category summary": made.category_summary.withColumnRenamed("category", "key"),
    }
    return schema.stack_rows([df.withColumn("part", F.lit(name)) for name, df in named.items()])


@query
def date_bounds(spark, folder):
    return aggregate.date_bounds(_facts(spark, folder), "invoice_date", ["city"])


# Profile and quality


@query
def row_overview(spark, folder):
    return profile.overview(dirty(spark, folder))


@query
def numeric_summary(spark, folder):
    found = profile.numeric_summary(sales(spark, folder, ("total_sales", "quantity")), method="exact")
    # The sums behind these two depend on the order of the rows in the last digits.
    return found.withColumns({c: F.round(c, 2) for c in ("mean", "stddev")})


@query
def text_summary(spark, folder):
    return profile.text_summary(dirty(spark, folder, ["invoice_date", "city", "category_hi", "quantity"]))


@query
def value_counts(spark, folder):
    rows = dirty(spark, folder, ["city_hi", "category_hi", "l_linenumber"])
    return profile.value_counts(rows)


@query
def most_frequent_values(spark, folder):
    rows = dirty(spark, folder, ["city_hi"])
    return ranking.head(profile.value_counts(rows), [F.desc("n"), "value"], 3)


@query
def profile_all(spark, folder):
    rows = dirty(spark, folder, ["invoice_date", "city_hi", "category_hi", "quantity"])
    parts = profile.explore(rows, all=True, top=None)
    nulls = parts["nulls"].unpivot([], rows.columns, "subject", "value")
    flat = {
        "schema": parts["schema"].select(F.concat_ws(" ", "column", "type").alias("subject"), F.col("filled").alias("value")),
        "overview": parts["overview"].select(F.col("names").alias("subject"), F.col("rows").alias("value")),
        "summary": parts["summary"].select(F.col("column").alias("subject"), F.col("count").alias("value")),
        "text_summary": parts["text_summary"].select(F.col("column").alias("subject"), F.col("count").alias("value")),
        "nulls": nulls,
        "duplicates": parts["duplicates"].select(F.lit("groups").alias("subject"), F.col("duplicate_groups").alias("value")),
        "value_counts": parts["value_counts"].select(
            F.concat_ws("=", "column", F.coalesce("value", F.lit("null"))).alias("subject"), F.col("n").alias("value")
        ),
    }
    return schema.stack_rows(
        [df.select(F.lit(part).alias("part"), "subject", "value") for part, df in flat.items()]
    )


@query
def quality_report(spark, folder):
    rows = dirty(spark, folder, ["invoice_date", "city", "category", "total_sales"])
    return quality.quality_report(aggregate.add_period(rows, "invoice_date", "week", WEEK), NAMES)


@query
def first_dates(spark, folder):
    return ranking.first_dates(_facts(spark, folder), "invoice_date")


@query
def head_by_week(spark, folder):
    return ranking.head(_weekly(spark, folder, "city", CITY_SALES), [WEEK, "city"], 14)


@query
def random_sample(spark, folder):
    """Size of a sample, how many of its rows are in the table, and whether its seed repeats it."""
    rows = sales(spark, folder, ("invoice_id",))
    sides = [ranking.random_sample(rows, 10, seed=7).withColumn("side", F.lit(side)) for side in ("a", "b")]
    drawn = sides[0].unionByName(sides[1]).groupBy("invoice_id").pivot("side", ["a", "b"]).count()
    known = rows.distinct().withColumn("known", F.lit(True))
    return drawn.join(known, "invoice_id", "left").agg(
        F.count("a").alias("n"),
        F.count_if(F.col("known") & F.col("a").isNotNull()).alias("known"),
        F.bool_and(F.col("a").eqNullSafe(F.col("b"))).alias("repeatable"),
    )


# Series


def _rounded(df):
    """Engines add up squares differently in the last digits."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 4) for c in df.columns if "_rollstd" in c})


def _series(spark, folder):
    return _weekly(spark, folder)


@query
def lag_features(spark, folder):
    return features.add_lag_features(_series(spark, folder), "category", CATEGORY_SALES, date=WEEK)


@query
def rolling_mean(spark, folder):
    return features.add_rolling_means(_series(spark, folder), "category", CATEGORY_SALES, date=WEEK)


@query
def rolling_stddev(spark, folder):
    weekly = _series(spark, folder)
    return _rounded(features.add_rolling_stddevs(weekly, "category", CATEGORY_SALES, date=WEEK))


@query
def trend_features(spark, folder):
    lagged = features.add_lag_features(_series(spark, folder), "category", CATEGORY_SALES, [1, 2], WEEK)
    return features.add_trend_features(lagged, CATEGORY_SALES)


@query
def trend_features_with_eps(spark, folder):
    lagged = features.add_lag_features(_series(spark, folder), "category", CATEGORY_SALES, [1, 2], WEEK)
    return features.add_trend_features(lagged, CATEGORY_SALES, eps=1e-6)


@query
def interaction_features(spark, folder):
    lagged = features.add_lag_features(_series(spark, folder), "category", CATEGORY_SALES, [1], WEEK)
    return features.add_interaction_features(features.add_date_parts(lagged, WEEK), CATEGORY_SALES)


@query
def features_run_all(spark, folder):
    return _rounded(features.run_all(_series(spark, folder), "category", CATEGORY_SALES, date=WEEK))


@query
def features_add_all(spark, folder):
    weekly = _weekly(spark, folder, "city", CITY_SALES)
    return _rounded(features.add_all(weekly, "city", CITY_SALES, WEEK))


def _featured(spark, folder, grain, lags, windows):
    rows = sales(spark, folder, ("invoice_date", "category", "total_sales"))
    totals = aggregate.sales_by_period(
        rows, "category", "invoice_date", "total_sales", grain, WEEK, CATEGORY_SALES
    )
    return _rounded(features.run_all(totals, "category", CATEGORY_SALES, lags, windows, WEEK))


@query
def features_on_every_day(spark, folder):
    rows = sales(spark, folder, ("invoice_date", "category", "total_sales"))
    totals = aggregate.sales_by_period(
        rows, "category", "invoice_date", "total_sales", "day", WEEK, CATEGORY_SALES
    )
    dense = features.run_all(totals, "category", CATEGORY_SALES, [1, 2, 7], [2, 7], WEEK, densify=True, grain="day")
    return _rounded(dense).drop("is_missing")


@query
def features_daily(spark, folder):
    return _featured(spark, folder, "day", [1, 2, 7], [2, 7])


@query
def features_monthly(spark, folder):
    return _featured(spark, folder, "month", [1, 2], [2])


@query
def features_on_every_week(spark, folder):
    """Not every city sells in every week."""
    weekly = _weekly(spark, folder, "city", CITY_SALES)
    dense = features.run_all(weekly, "city", CITY_SALES, [1, 2], [2], WEEK, densify=True)
    return _rounded(dense).drop("is_missing")


@query
def week_spine(spark, folder):
    return spine.spine(_weekly(spark, folder, "city", CITY_SALES), WEEK, ["city"])


@query
def missing_weeks(spark, folder):
    return spine.missing_periods(_weekly(spark, folder, "city", CITY_SALES), WEEK, ["city"])


@query
def missing_days_of_table(spark, folder):
    days = sales(spark, folder, ("invoice_date", "category"))
    return spine.missing_periods(days, "invoice_date", ["category"], grain="day")


@query
def date_continuity(spark, folder):
    rows = sales(spark, folder, ("invoice_date", "city", "total_sales"))
    rows = spine.ensure_continuity(rows, "invoice_date", ["city"])
    return rows.groupBy("city", "invoice_date", "is_missing").agg(
        F.count(F.lit(1)).alias("n"), total(F.col("total_sales")).alias("sales")
    )


# Whole flows


@query
def wrangle_quality(spark, folder):
    """Cleaned, capped and exported rows, as the quality checks see them."""
    made = wrangle(
        _raw_sales(spark, folder), shared_folder(spark, "wrangled"), NAMES, identity=["invoice_id"]
    )
    return made.quality.report


@query
def wrangle_outliers(spark, folder):
    """Fences and capped values, as the flow reports them."""
    raw = _raw_sales(spark, folder)
    return wrangle(raw, shared_folder(spark, "wrangled"), NAMES, identity=["invoice_id"]).outliers


@query
def wrangle_duplicates(spark, folder):
    """Rows that the flow dropped as duplicates."""
    raw = _raw_sales(spark, folder)
    return wrangle(raw, shared_folder(spark, "wrangled"), NAMES, identity=["invoice_id"]).duplicates


def _exported(spark, folder, grain, name):
    target = shared_folder(spark, "wrangled")
    wrangle(_raw_sales(spark, folder), target, NAMES, identity=["invoice_id"], grains=[grain])
    return read_latest(spark, target, name)


@query
def wrangle_daily(spark, folder):
    return _exported(spark, folder, "day", "city_sales_daily")


@query
def wrangle_monthly(spark, folder):
    return _exported(spark, folder, "month", "category_sales_monthly")


def _text_sales(spark, folder):
    """Raw rows whose sales are text, some of it no number and some with more digits than are kept."""
    rows = _landed(spark, folder, [*KEY, "invoice_id", "invoice_date", "city", "category", "full_sales"])
    written = F.when(F.col("l_orderkey") % 89 == 0, F.lit("n/a")).when(
        F.col("l_orderkey") % 83 == 0, F.concat(F.col("full_sales").cast("string"), F.lit("09"))
    ).otherwise(F.col("full_sales").cast("string"))
    return rows.withColumn("total_sales", written).drop(*KEY, "full_sales")


@query
def rejected_values(spark, folder):
    return quality.rejects(_text_sales(spark, folder), NAMES)


@query
def clean_text_sales(spark, folder):
    """What is no number is filled like a missing one; numbers come through."""
    cleaned = clean(_text_sales(spark, folder), NAMES, [], dedup_keys=["invoice_id"])
    return cleaned.groupBy("city", "category").agg(
        F.count(F.lit(1)).alias("n"), F.count("total_sales").alias("filled"), F.count_distinct("invoice_date").alias("dates")
    )


@query
def most_frequent_of_each(spark, folder):
    return profile.value_counts(dirty(spark, folder, ["city_hi", "category_hi", "invoice_id"]), top=3)


@query
def wrangle_to_features(spark, folder):
    """Raw rows to exported weekly tables, and those to exported features, read back."""
    target = shared_folder(spark, "wrangled")
    wrangle(_raw_sales(spark, folder), target, NAMES, identity=["invoice_id"])
    build_features(spark, target, NAMES)
    return _rounded(read_latest(spark, target, "category_sales_weekly_features"))
