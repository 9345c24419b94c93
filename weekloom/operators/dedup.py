"""Exact duplicates.

Rows are compared by a digest of 128 bits first. Counting digests moves 16 bytes a row; only rows whose digest
repeats have to meet as rows.

Whatever is compared is dealt by digest to parts of about ``ROWS_PER_PART`` rows, so a task's memory doesn't grow
with the table. It meets twice, first by where it comes from too, so that copies of one row, however many, are
reduced in several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.operators.schema import quoted
from weekloom.shared import materialise

#: Repeated digests that are broadcast, at most: 24 MB of numbers.
MOST_DIGESTS = 1_000_000
#: Rows that one task compares, about, and the groups of partitions whose copies are reduced apart.
ROWS_PER_PART, ORIGINS = 500_000, 64
_DIGEST, _ORIGIN, _N = "__digest", "__origin", "__n"


def _digest(df: DataFrame, keys: Sequence[str] | None) -> list[Column]:
    """Two independent 64-bit hashes. A hash passes over nulls, so which cells are null is hashed too."""
    columns = [F.col(quoted(c)) for c in keys or df.columns]
    nulls = F.concat(*[c.isNull().cast("string") for c in columns])
    return [F.xxhash64(nulls, *columns).alias("d1"), F.xxhash64(*reversed(columns), nulls, F.lit(1)).alias("d2")]


def _parts(df: DataFrame, rows: int | None) -> int:
    rows = df.count() if rows is None else rows
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_PART))


def _counted(df: DataFrame, digest: Column, rows: int | None = None) -> DataFrame:
    """The distinct rows of ``df`` with their number, ``__n``; ``digest`` is the same for equal rows."""
    columns, n = [F.col(quoted(c)) for c in df.columns], _parts(df, rows)
    # A partition's number is the same if its task is repeated.
    dealt = df.select(*columns, digest.alias(_DIGEST), F.pmod(F.spark_partition_id(), F.lit(ORIGINS)).alias(_ORIGIN))
    near = dealt.repartition(n, _DIGEST, _ORIGIN).groupBy(_DIGEST, _ORIGIN, *columns).agg(F.count(F.lit(1)).alias(_N))
    near = near.select(_DIGEST, *columns, _N).repartition(n, _DIGEST)
    return near.groupBy(_DIGEST, *columns).agg(F.sum(_N).alias(_N)).select(*columns, _N)


def drop_duplicates(df: DataFrame, keys: Sequence[str] | None = None, rows: int | None = None) -> DataFrame:
    """Keep one of each set of equal rows, or of rows equal in ``keys``.

    ``rows``, the number of rows, is counted if it isn't given; the rest is lazy.
    """
    keys, n = list(keys or df.columns), _parts(df, rows)
    dealt = df.withColumns({_DIGEST: _digest(df, keys)[0], _ORIGIN: F.pmod(F.spark_partition_id(), F.lit(ORIGINS))})
    near = dealt.repartition(n, _DIGEST, _ORIGIN).dropDuplicates([_DIGEST, _ORIGIN, *keys]).drop(_ORIGIN)
    return near.repartition(n, _DIGEST).dropDuplicates([_DIGEST, *keys]).drop(_DIGEST)


@dataclass(frozen=True)
class Deduplicated:
    """The rows, and one row with what was dropped (``duplicate_groups``, ``surplus_rows``)."""

    rows: DataFrame
    report: DataFrame


def deduplicate(df: DataFrame, keys: Sequence[str] | None = None) -> Deduplicated:
    """As ``drop_duplicates``, with the report, from one count of digests, which is made at once.

    Rows whose digest is single stay where they are. If more than ``MOST_DIGESTS`` digests repeat, all
    rows move once instead.
    """
    repeated = materialise(_counted_digests(df, keys).where(F.col("n") > 1), "repeated-digests")
    report = _report(repeated)
    groups, surplus = report.first()
    if groups > MOST_DIGESTS:
        return Deduplicated(drop_duplicates(df, keys), report)
    if not groups:
        return Deduplicated(df, report)
    marked = _marked(df, keys, repeated)
    rest = marked.where(~F.col("repeats")).select("row.*")
    copies = marked.where("repeats").select("row.*")
    return Deduplicated(rest.unionByName(drop_duplicates(copies, keys, groups + surplus)), report)


def _counted_digests(df: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    return _counted(df.select(*_digest(df, keys)), F.col("d1")).withColumnRenamed(_N, "n")


def _marked(df: DataFrame, keys: Sequence[str] | None, repeated: DataFrame) -> DataFrame:
    """``row`` and whether its digest is among the ``repeated`` ones, a bounded number, which are broadcast."""
    rows = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), *_digest(df, keys))
    found = F.broadcast(repeated.select("d1", "d2", F.lit(True).alias("found")))
    return rows.join(found, ["d1", "d2"], "left").select("row", F.coalesce("found", F.lit(False)).alias("repeats"))


def duplicate_groups(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Row values that occur more than once, with how often (``n_dup``)."""
    digest = _digest(df, keys)[0]
    counted = _counted(df.select(*[quoted(c) for c in keys or df.columns]), digest)
    return counted.where(F.col(_N) > 1).withColumnRenamed(_N, "n_dup")


def duplicate_counts(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: duplicated values, and surplus rows that ``drop_duplicates`` would remove.

    From digests alone: two different rows count as one with a chance of 2 ** -128 a pair.
    """
    return _report(_counted_digests(df, keys).where(F.col("n") > 1))


def _report(repeated: DataFrame) -> DataFrame:
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )
