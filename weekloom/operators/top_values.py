"""The most frequent values of columns, exact, without shuffling values that cannot be among them.

A frequent-items sketch of all columns names candidates in one pass; a second pass counts them exactly. The
sketch's error bounds how often any other value can occur, so if the last wanted candidate occurs more often,
nothing else can enter. Columns without such a proof, as their values hardly repeat, are counted by 64-bit hashes
of their values, and only values whose hash is frequent enough are looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.schema import quoted
from weekloom.shared import materialise

#: Values a sketch keeps track of, and the largest error of its counts as a share of the rows: 3.5 over the
#: next power of two that has a quarter to spare.
TRACKED = 8_000
ERROR = 3.5 / 16_384
#: Hashes whose values are looked at, at most; beyond, all values of the column are counted.
MOST_HASHES = 100_000
#: Parts in which counts are ranked first.
PARTS = 512


def _text(column: str) -> Column:
    """A value as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(quoted(column)).cast("string")), F.lit(""))


def _best(counts: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows per column, ranked in parts before they are ranked together."""
    part = F.pmod(F.xxhash64("value"), F.lit(PARTS))
    local = F.row_number().over(Window.partitionBy("column", part).orderBy(*order))
    whole = F.row_number().over(Window.partitionBy("column").orderBy(*order))
    few = counts.withColumn("rank", local).where(F.col("rank") <= n)
    return few.withColumn("rank", whole).where(F.col("rank") <= n).drop("rank")


def _stacked(df: DataFrame, columns: Sequence[str], value) -> DataFrame:
    """``column`` (its position) and ``value`` of every cell."""
    cells = [F.struct(F.lit(i).alias("column"), value(c).alias("value")) for i, c in enumerate(columns)]
    return df.select(F.inline(F.array(*cells)))


def _counted(df: DataFrame, columns: Sequence[str], wanted: dict[int, list[str]]) -> DataFrame:
    """Exact counts of the ``wanted`` values; other values leave the scan as nothing."""
    cells = [
        F.struct(F.lit(i).alias("column"), F.when(_text(columns[i]).isin(values), _text(columns[i])).alias("value"))
        for i, values in wanted.items()
    ]
    found = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    return found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """``column``, ``value`` (as text) and ``n`` of the ``n`` most frequent values per column, nulls included; ties
    go to the smaller value, and a null before all others."""
    columns = list(columns)
    k = min(TRACKED, 4 * n + 20)
    aliases = [f"v{i}" for i in range(len(columns))]
    texts = df.select(*[_text(c).alias(a) for c, a in zip(columns, aliases)])
    sketched = texts.agg(F.count(F.lit(1)).alias("rows"), *[F.expr(f"approx_top_k({a}, {k}, {TRACKED})").alias(a) for a in aliases]).first()
    rows = sketched["rows"]
    if not rows:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    wanted = {i: [f["item"] for f in sketched[a]] for i, a in enumerate(aliases)}
    # What is not named occurs at most as often as the last that is, or as a value that lost its place in the sketch.
    others = {i: (sketched[a][-1]["count"] if len(sketched[a]) == k else 0) + ERROR * rows for i, a in enumerate(aliases)}
    candidates = materialise(_counted(df, columns, wanted), "candidates")
    all_rows = {r["column"]: r["n"] for r in candidates.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    order = (F.desc("n"), F.col("value"))
    counts = _best(candidates, n, *order)
    least = {r["column"]: r for r in counts.groupBy("column").agg(F.min("n").alias("n"), F.count("*").alias("found")).collect()}
    # Proven: the candidates are all there is, or nothing else can be as frequent as the last one wanted.
    proven = [i for i in least if all_rows[i] == rows or (least[i]["found"] == n and least[i]["n"] > others[i])]
    parts = [counts.where(F.col("column").isin(proven))] if proven else []
    rest = [i for i in wanted if i not in proven]
    if rest:
        parts.append(_by_hash(df, [columns[i] for i in rest], n).withColumn("column", F.get(F.array(*map(F.lit, rest)), F.col("column"))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    name = F.get(F.array(*map(F.lit, columns)), F.col("column"))
    value = F.when(F.col("value") != "", F.substring("value", 2, 1 << 30))
    return out.select(name.alias("column"), value.alias("value"), "n")


def _by_hash(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """Top values of columns whose values hardly repeat.

    Counts of hashes are never smaller than those of their values. Wanted values have a hash that occurs
    at least as often as the n-th most frequent hash; where that is once, all values are single and the
    smallest are wanted; where too many hashes tie, the column's values are counted themselves.
    """
    order = (F.desc("n"), F.col("value"))
    hashes = _stacked(df, columns, lambda c: F.xxhash64(_text(c))).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    hashes = materialise(hashes, "hash-counts")
    best = _best(hashes, n, F.desc("n"), F.col("value")).groupBy("column").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("found"))
    bounds = {r["column"]: r for r in best.collect()}
    enough = hashes.join(F.broadcast(best), "column").where(F.col("n") >= F.col("least"))
    sizes = {r["column"]: r["count"] for r in enough.groupBy("column").count().collect()}
    single = [i for i, b in bounds.items() if b["most"] == 1]
    by_hash = [i for i in bounds if i not in single and sizes[i] <= MOST_HASHES]
    whole = [i for i in bounds if i not in single and i not in by_hash]
    found = []
    for i in single:
        smallest = df.select(F.lit(i).alias("column"), _text(columns[i]).alias("value"), F.lit(1).cast("long").alias("n"))
        found.append(smallest.orderBy("value").limit(n))
    if by_hash:
        few = F.broadcast(enough.where(F.col("column").isin(by_hash)).select("column", F.col("value").alias("hash")))
        cells = _stacked(df, columns, _text).withColumn("hash", F.xxhash64("value"))
        found.append(_best(cells.join(few, ["column", "hash"], "left_semi").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), n, *order))
    if whole:
        cells = _stacked(df, columns, _text).where(F.col("column").isin(whole))
        found.append(_best(cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), n, *order))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out
