"""Category indexing: dense numbers for values, however many there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.schema import quoted
from weekloom.shared import materialise

_PART_BITS = 33
#: Rows of one value that are joined by one task, at least; values beyond it that are looked up apart, at most.
SALT_ROWS, MOST_HOT = 100_000, 1_000


def dense_numbers(df: DataFrame, order: Sequence[Column], name: str = "id") -> DataFrame:
    """``df`` with ``name``, the number of rows before each in ``order``, which must be unique.

    Rows are sorted in ranges and written with their place; the ranges' sizes, one row each, give
    the offsets. No task sees all rows, and nothing is collected.
    """
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = cut.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("place"))
    placed = materialise(cut, "numbered")
    part, within = F.shiftright("place", _PART_BITS), F.col("place").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    sizes = placed.groupBy(part.alias("part")).agg((F.max(within) + 1).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range is all that one task sees.
    offsets = materialise(sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")), "range-offsets")
    numbered = placed.join(F.broadcast(offsets), part == F.col("part"))
    return numbered.select("row.*", (F.col("offset") + within).alias(name))


def category_index(df: DataFrame, columns: Sequence[str], order: str = "frequency") -> DataFrame:
    """``column``, ``value`` (as text), ``n`` (rows) and ``id`` of each value of the ``columns``.

    The ids of a column are dense and start at 0, with the most frequent value, ties in text order, or
    with ``order="value"`` in text order alone. Nulls are no category. Values are counted before they
    are shuffled, so a value that holds a third of the rows moves as one row per task.
    """
    texts = [F.col(quoted(c)).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]
    names = F.array(*[F.lit(c) for c in columns])
    counted = (
        df.select(*texts)
        .unpivot([], [f"c{i}" for i in range(len(columns))], "of", "value")
        .where(F.col("value").isNotNull())
        .groupBy("of", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("of", F.substring("of", 2, 9).cast("int"))
    )
    by = {"frequency": [F.desc("n"), F.col("value")], "value": [F.col("value")]}[order]
    numbered = dense_numbers(counted, [F.col("of"), *by], "id")
    first = numbered.groupBy("of").agg(F.min("id").alias("first"))  # one row per column
    return numbered.join(F.broadcast(first), "of").select(
        F.get(names, F.col("of")).alias("column"), "value", "n", (F.col("id") - F.col("first")).alias("id")
    )


def index_categories(df: DataFrame, columns: Sequence[str], suffix: str = " Index", order: str = "frequency") -> DataFrame:
    """``df`` with an index column per column; the index of a null is null."""
    index = materialise(category_index(df, columns, order), "category-index")
    for c in columns:
        of = index.where(F.col("column") == F.lit(c)).select("value", F.col("id").alias(f"{c}{suffix}"))
        df = join_by_value(df, of, F.col(quoted(c)).cast("string"))
    return df


def join_by_value(df: DataFrame, lookup: DataFrame, key: Column) -> DataFrame:
    """``df`` with the columns of ``lookup``, whose first column holds distinct values, where that is ``key``; else nulls.

    Any number of rows may share a key. One with more than ``SALT_ROWS`` rows, and more than a
    ``MOST_HOT``-th of all, is hot. There are fewer than ``MOST_HOT`` of them; they are broadcast with the number of parts
    their rows are dealt to, and ``lookup`` has their row once per part. Rows without a key are dealt likewise.
    """
    value, *others = lookup.columns
    keyed = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), key.alias("key"))
    counts = materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key-counts")
    least = max(SALT_ROWS, (counts.agg(F.sum("n")).first()[0] or 0) // MOST_HOT)
    hot = F.broadcast(
        counts.where(F.col("n") > least).select(F.col("key").alias("hot"), F.ceil(F.col("n") / least).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    dealt = keyed.join(hot, F.col("key").eqNullSafe(F.col("hot")), "left").select(
        "row", "key", F.pmod(F.monotonically_increasing_id(), parts).cast("int").alias("part")
    )
    found = lookup.select(F.col(quoted(value)).alias("value"), F.struct(*[quoted(c) for c in others]).alias("found"))
    found = found.join(hot, F.col("value") == F.col("hot"), "left").select(
        F.col("value").alias("key"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "found"
    )
    return dealt.join(found, ["key", "part"], "left").select("row.*", "found.*")
