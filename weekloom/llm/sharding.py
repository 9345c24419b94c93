"""Best-fit-decreasing packing of indivisible groups into shards.

A group is all rows of one text. Groups enter, largest first, the bin whose remaining capacity is
the tightest that holds them; the bins' remaining capacities are kept in a balanced tree.

The packing has two levels. Groups are dealt by hash into parts of about ``PART`` groups, and each
part packs its groups into chunks, small bins of a fixed share of a shard; a larger group is
a chunk by itself. The chunks, whose number follows from the shards and parts and not from the rows,
are packed the same way into shards. For a fixed number of shards the smallest capacity that holds
everything is searched for; for a fixed capacity, shards are opened as needed.

Rows meet their group by a join on the text's digest, which adaptive execution splits for texts
with very many copies. Slots are numbered within hash buckets of a shard, after the counts of the
buckets before, so no shard is sorted in one task.

Defined results: a null text has one byte and no checksum, and all null texts are one group; rows
that share an id are rows of their own; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.storage import landed

#: Groups per part of the first level, chunks per shard, rows per bucket of slots.
PART, CHUNKS, BUCKET = 250_000, 256, 50_000


class CapacityTree:
    """Ordered (remaining, bin) pairs: a tree of two levels whose leaves are split when full."""

    LEAF = 256

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.highest: list[tuple[int, int]] = [(-1, -1)]

    def add(self, item: tuple[int, int]) -> None:
        at = min(bisect_left(self.highest, item), len(self.leaves) - 1)
        leaf = self.leaves[at]
        insort(leaf, item)
        if len(leaf) > self.LEAF:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.highest[at : at + 1] = [leaf[half - 1], leaf[-1]]
        else:
            self.highest[at] = leaf[-1]

    def pop_tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the smallest pair with ``remaining >= size``."""
        at = bisect_left(self.highest, (size, -1))
        if at == len(self.leaves) or not self.leaves[at]:
            return None
        leaf = self.leaves[at]
        item = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.highest[at] = leaf[-1]
        elif len(self.leaves) > 1:
            del self.leaves[at], self.highest[at]
        else:
            self.highest[at] = (-1, -1)
        return item


def best_fit_decreasing(sizes: Iterable[int], capacity: int) -> tuple[list[int], int]:
    """The bin of each of ``sizes``, which come in decreasing order, and the number of bins. An item
    above the capacity has a bin to itself."""
    tree, bins, n = CapacityTree(), [], 0
    for size in sizes:
        held = tree.pop_tightest(size)
        if held is None:
            held = (capacity, n)
            n += 1
        remaining = held[0] - size
        bins.append(held[1])
        if remaining > 0:
            tree.add((remaining, held[1]))
    return bins, n


def fewest_capacity(sizes: list[int], shards: int) -> list[int]:
    """The shard of each of ``sizes`` (decreasing), with the smallest capacity that the search finds."""
    low = max(-(-sum(sizes) // shards), sizes[0])
    high, best = max(low, 2 * low), None
    while low <= high:
        capacity = (low + high) // 2
        bins, n = best_fit_decreasing(sizes, capacity)
        if n <= shards:
            best, high = bins, capacity - 1
        else:
            low = capacity + 1
    return best if best is not None else best_fit_decreasing(sizes, sum(sizes))[0]


def _pack_part(capacity: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["size", "digest"], ascending=[False, True])
        part["bin"] = best_fit_decreasing(part["size"].tolist(), capacity)[0]
        return part[["digest", "part", "bin", "size"]]

    return run


def pack(
    docs: DataFrame,
    shards: int | None = None,
    capacity: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row. Give ``shards`` for that many of
    nearly equal bytes, or ``capacity`` for as few as the packing finds, none larger (but for
    a group that alone is larger)."""
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    text = F.col(f"`{text_col}`")
    rows = landed(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"")).alias("digest"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    total, n_groups = groups.agg(F.sum("size"), F.count("*")).first()
    if not n_groups:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    limit = max(1, total // (shards * CHUNKS)) if shards else capacity
    parts = -(-n_groups // PART)
    packed = landed(
        groups.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int"))
        .groupBy("part")
        .applyInPandas(_pack_part(limit), "digest binary, part int, bin int, size long"),
        "shard-chunks",
    )
    chunks = packed.groupBy("part", "bin").agg(F.sum("size").alias("size"))
    if shards:
        # About CHUNKS per shard, one unfilled chunk per part, and groups larger than a chunk.
        open_chunks, first = chunks, 0
    else:
        # Chunks filled to within a CHUNKS-th are shards already; the rest are packed again.
        full = F.col("size") > capacity - capacity / CHUNKS
        closed = chunks.where(full).withColumn("shard", F.row_number().over(Window.orderBy("part", "bin")) - 1)
        closed = landed(closed.select("part", "bin", "shard"), "shard-closed")
        open_chunks, first = chunks.where(~full), closed.count()
    listed = open_chunks.orderBy(F.desc("size"), "part", "bin").collect()
    sizes = [r["size"] for r in listed]
    bins = fewest_capacity(sizes, shards) if shards else best_fit_decreasing(sizes, capacity)[0]
    spark = docs.sparkSession
    chosen = spark.createDataFrame(
        [(r["part"], r["bin"], b + first) for r, b in zip(listed, bins)], "part int, bin int, shard int"
    )
    if not shards:
        chosen = chosen.unionByName(closed)
    of_group = packed.join(chosen, ["part", "bin"]).select("digest", "shard")
    buckets = -(-rows.count() // BUCKET)
    placed = landed(
        rows.join(of_group, "digest")
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(buckets)).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "bucket"),
        "shard-placed",
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = offsets.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    return (
        placed.withColumn("number", F.row_number().over(within))
        .join(offsets, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("number") - 1).alias("slot"))
    )
