"""Forward fill in a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.schema import quoted, require_columns
from weekloom.shared import materialise

ROWS_PER_RANGE = 500_000
_RANGE, _PLACE, _CARRY = "range", "place", "carry"


def forward_fill(
    df: DataFrame,
    column: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    ranges: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Fill nulls with the last value before them.

    ``order_by`` must be unique, within ``partition_by`` if that is given: a
    distributed table has no physical row order to fall back on. The table is
    sorted into ranges of (partition, order), whichever key a row has, so one hot
    partition is spread over many tasks like the rest, and written once with each
    row's place. Each range is filled by itself; its leading nulls take the value
    carried over from earlier ranges, for which one row per range is enough.
    """
    if not order_by:
        raise ValueError("forward fill needs columns that order the rows")
    require_columns(df, [column, *order_by, *partition_by])
    ranges = _ranges(df, rows) if ranges is None else ranges
    ordered = in_ranges(df, [*partition_by, *order_by], ranges)
    window = (
        Window.partitionBy(_RANGE, *[_of_row(c) for c in partition_by])
        .orderBy(_PLACE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # In as many tasks as ranges: by default their number doesn't grow with the table.
    met = ordered.repartitionByRange(ranges, _RANGE)
    filled = met.withColumn("filled", F.last(_of_row(column), ignorenulls=True).over(window))
    carried = _carried(ordered, column, partition_by)
    carry = F.when(_group(partition_by) == F.col(f"{_CARRY}.group"), F.col(f"{_CARRY}.value"))
    value = F.coalesce(F.col("filled"), carry)
    return filled.join(F.broadcast(carried), _RANGE, "left").select(
        *[(value if c == column else _of_row(c)).alias(c) for c in df.columns]
    )


def _of_row(column: str) -> Column:
    return F.col(f"row.{quoted(column)}")


def _ranges(df: DataFrame, rows: int | None) -> int:
    rows = df.count() if rows is None else rows
    return max(df.sparkSession.sparkContext.defaultParallelism, rows // ROWS_PER_RANGE)


def in_ranges(
    df: DataFrame, keys: Sequence[str], ranges: int | None = None, rows: int | None = None
) -> DataFrame:
    """The rows, sorted by ``keys`` into consecutive ranges and stored with range and place.

    A place is a number that grows with the order. Both are written with the row,
    so a repeated task can't number it differently. The row is a struct, ``row``, whose columns
    may have any names.
    """
    ranges = _ranges(df, rows) if ranges is None else ranges
    order = [F.col(quoted(c)).asc_nulls_first() for c in keys]
    cut = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    row = F.struct(*[quoted(c) for c in df.columns]).alias("row")
    placed = cut.select(row, F.spark_partition_id().alias(_RANGE), F.monotonically_increasing_id().alias(_PLACE))
    return materialise(placed, "ranges")


def _group(partition_by: Sequence[str]):
    """The partition a row belongs to. Structs compare null fields as equal."""
    return F.struct(F.lit(0), *[_of_row(c) for c in partition_by])


def _carried(ordered: DataFrame, column: str, partition_by: Sequence[str]):
    """For each range, the value that its first partition brings from earlier ranges."""
    filled = F.when(_of_row(column).isNotNull(), F.col(_PLACE))
    places = ordered.groupBy(_RANGE).agg(
        F.min(_PLACE).alias("first"), F.max(_PLACE).alias("last"), F.max(filled).alias("top")
    )
    # At most three rows of each range are looked at again.
    wanted = places.select(F.explode(F.array_distinct(F.array("first", "last", "top"))).alias(_PLACE))
    rows = ordered.select(_PLACE, _group(partition_by).alias("group"), _of_row(column).alias("value"))
    picked = rows.join(wanted, _PLACE)

    def at(edge: str) -> DataFrame:
        return picked.select(F.col(_PLACE).alias(edge), F.struct("group", "value").alias(f"at_{edge}"))

    edges = places.join(at("first"), "first").join(at("last"), "last").join(at("top"), "top", "left")
    # A range asks on behalf of its first partition and offers for its last one.
    asks = F.struct(F.col("at_first.group").alias("group"), F.lit(0).alias("offer"), F.lit(None).alias("value"))
    offers = F.struct(
        F.col("at_last.group").alias("group"),
        F.lit(1).alias("offer"),
        F.when(F.col("at_top.group") == F.col("at_last.group"), F.col("at_top.value")).alias("value"),
    )
    before = (
        Window.partitionBy("group")
        .orderBy(_RANGE, "offer")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        edges.select(_RANGE, F.inline(F.array(asks, offers)))
        .withColumn("value", F.last("value", ignorenulls=True).over(before))
        .where(F.col("offer") == 0)
        .select(_RANGE, F.struct("group", "value").alias(_CARRY))
    )
