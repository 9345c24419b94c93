"""Positions in a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.storage import landed

_PART_BITS = 33


def positions(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` with ``position``, the number of rows before each in ``order``, which must be unique.

    Rows are sorted in ranges and written with their place in the range. One row per range, its size,
    gives the ranges' offsets; it is all that is broadcast, and all that one task sees of the whole.
    """
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = landed(cut.withColumn("place", F.monotonically_increasing_id()), label)
    part, within = F.shiftright("place", _PART_BITS), F.col("place").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    sizes = placed.groupBy(part.alias("of_part")).agg((F.max(within) + 1).alias("n"))
    before = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("of_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return (
        placed.join(F.broadcast(offsets), part == F.col("of_part"))
        .withColumn("position", F.col("offset") + within)
        .drop("place", "of_part", "offset")
    )
