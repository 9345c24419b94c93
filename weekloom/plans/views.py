"""The given star-schema tables seen as retail sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.columns import SalesColumns
from weekloom.sources.read import load_data

NAMES = SalesColumns("invoice_date", "city", "category", "total_sales", "week_start")
KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_ALL = (*KEY, "invoice_id", "invoice_date", "city", "category", "total_sales", "quantity")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_data(spark, f"{folder}/{name}.parquet", "parquet")


def _orders(spark: SparkSession, folder: str, with_city: bool) -> DataFrame:
    """Orders with their date and city: the smaller tables are joined first."""
    orders = table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date").alias("o_date")
    if not with_city:
        return orders.select("o_orderkey", day)
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
    customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", day, "n_name"
    )


def sales(spark: SparkSession, folder: str, columns: Sequence[str] = _ALL) -> DataFrame:
    """Line items with date, city and category looked up; only the lookups asked for are joined."""
    rows = table(spark, folder, "lineitem")
    if {"invoice_date", "city"} & set(columns):
        orders = _orders(spark, folder, "city" in columns)
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "category" in columns:
        parts = table(spark, folder, "part")
        rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    one = F.lit(1).cast("decimal(3,2)")
    derived = {
        "invoice_id": F.concat_ws("-", *KEY),
        "invoice_date": F.col("o_date"),
        "city": F.col("n_name"),
        "category": F.col("p_type"),
        # Exact before the product: doubles would round differently per engine.
        "total_sales": F.col("l_extendedprice").cast("decimal(12,2)")
        * (one - F.col("l_discount").cast("decimal(3,2)")),
        "quantity": F.col("l_quantity"),
    }
    return rows.select(*[derived.get(c, F.col(c)).alias(c) for c in columns])


def dirty(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Sales with nulls, text dates, untidy text and exact duplicates.

    ``city_hi``, ``category_hi`` and ``date_hi`` have more nulls than their
    namesakes, so that both sides of each threshold are met.
    """
    order, part, line = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_linenumber"))

    def but_null(hit, value):
        return F.when(~hit, value)

    date_text = F.date_format("invoice_date", "MM/dd/yyyy")
    untidy = F.concat(F.lit("  "), F.upper("city"), F.lit("*& "))
    defects = {
        "total_sales": but_null((order * 7 + line) % 50 == 0, F.col("total_sales")),
        "full_sales": F.col("total_sales"),
        "city": but_null(
            (order * 3 + line) % 40 == 0, F.when(line % 2 == 0, untidy).otherwise(F.col("city"))
        ),
        "city_hi": but_null((order * 3 + line) % 12 == 0, F.col("city")),
        "category": but_null((part * 5 + line) % 150 == 0, F.col("category")),
        "category_hi": but_null((part * 5 + line) % 30 == 0, F.col("category")),
        "invoice_date": but_null(
            (order * 11 + line) % 60 == 0,
            F.when(order % 97 == 0, F.lit("n/a")).otherwise(date_text),
        ),
        "date_hi": but_null((order * 11 + line) % 15 == 0, F.col("invoice_date")),
    }
    plain = [*KEY, "invoice_id", "quantity"]
    columns = list(columns) if columns is not None else [*plain, *defects]
    source = {"city_hi": "city", "category_hi": "category", "date_hi": "invoice_date", "full_sales": "total_sales"}
    needed = dict.fromkeys([*KEY, *[source.get(c, c) for c in columns]])
    rows = sales(spark, folder, tuple(needed))
    # Repeat the chosen orders in place: a union would scan and join everything twice.
    copies = F.explode(F.when(order % 40 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.withColumn("copy", copies).select(
        *[defects[c].alias(c) if c in defects else F.col(c) for c in columns]
    )
