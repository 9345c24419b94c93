"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Every source gets a target in words, every document of it the same wished number of copies
``target / source size``. Its whole part is certain; the fractional parts are rounded together.
Two fractional documents meet, and words are moved from one to the other, in a direction drawn at
random so that expectations hold, until one of them is 0 or 1. What is moved is words, not
probability, so a source's sum of words is kept at each step, and misses its target in the end by
less than one document.

The meetings form a tree. Documents are dealt by hash into blocks of about ``BLOCK``; a block's
chain settles all but one; the ones left over are dealt again, until each source has one left, which
is drawn by itself. Blocks come from counts and hashes of the ids, so neither partitions nor order
change the result, and a hot source merely has more blocks.

Defined results: a null or empty text has size 0, takes part without words, and never uses up
a target; a null source is a source, the last one; an empty table gives an empty one; rows that
agree in all of ``keys``, source and size are rounded as one unit of their number, and the first of
them get its copies. Further columns of the input are ignored and can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.storage import landed

#: Documents per block of the tree.
BLOCK = 64
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """One row per source with its size, the target and the copies wished for each document.

    Sources are filled in proportion to their weights, up to ``most`` times their size. The level
    at which the total is reached follows from sums over the sources in order of the level at which
    they are full, so resharing needs no iteration.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, len(weights)) + 1)
    sources = sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    all_rows = Window.partitionBy()
    total = share * F.sum("source_size").over(all_rows)
    sources = sources.withColumn("level", (total - full) / rest)
    open_level = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))
    sources = sources.withColumn("level", F.first(open_level, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap"))
    sources = sources.withColumn("target", target)
    wish = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most)))
    return sources.select("source", "source_size", "source_rows", "target", F.coalesce(wish, F.lit(0.0)).alias("wish"))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def _meet(state: Column, new: Column, seed: int, empty: Column) -> Column:
    """One step of a block's chain: settle one of the open unit and the next one."""

    def unit(of: Column, p: Column) -> Column:
        return F.struct(of["w"].alias("w"), of["k"].alias("k"), p.alias("p"))

    def settled(of: Column, take: Column) -> Column:
        return F.array(F.struct(of["k"].alias("k"), take.cast("int").alias("take")))

    def moved(m: Column) -> Column:
        a, b = state["open"], new
        by = F.when(m["up"], m["gain"]).otherwise(-m["loss"])
        # The first to meet its bound settles: a at 1 or b at 0 going up, a at 0 or b at 1 going down.
        a_first = F.when(m["up"], (1 - a["p"]) * a["w"] <= b["p"] * b["w"]).otherwise(a["p"] * a["w"] <= (1 - b["p"]) * b["w"])
        left = F.when(a_first, unit(b, F.greatest(F.lit(0.0), F.least(F.lit(1.0), b["p"] - by / b["w"])))).otherwise(
            unit(a, F.greatest(F.lit(0.0), F.least(F.lit(1.0), a["p"] + by / a["w"])))
        )
        done = F.when(a_first, settled(a, m["up"])).otherwise(settled(b, ~m["up"]))
        return F.struct(left.alias("open"), F.concat(state["done"], done).alias("done"))

    a, b = state["open"], new
    gain = F.least((1 - a["p"]) * a["w"], b["p"] * b["w"])
    loss = F.least(a["p"] * a["w"], (1 - b["p"]) * b["w"])
    drawn = _uniform(a["k"], b["k"], F.lit(seed))
    move = _let(
        F.struct(gain.alias("gain"), loss.alias("loss"), drawn.alias("u")),
        lambda m: F.struct(m["gain"].alias("gain"), m["loss"].alias("loss"), (m["u"] * (m["gain"] + m["loss"]) < m["loss"]).alias("up")),
    )
    return F.when(a.isNull(), F.struct(unit(new, new["p"]).alias("open"), empty.alias("done"))).otherwise(_let(move, moved))


def _round(units: DataFrame, seed: int) -> DataFrame:
    """``k`` and ``take`` (0 or 1) of each unit (``source``, ``n`` units of the source, ``w``, ``k``, ``p``)."""
    kind = units.schema["k"].dataType.simpleString()
    unit_type, done_type = f"struct<w:double,k:{kind},p:double>", f"array<struct<k:{kind},take:int>>"
    settled, level = [], 0
    while True:
        blocks = F.ceil(F.col("n") / BLOCK)
        block = F.pmod(F.xxhash64("k", F.lit(seed + level)), blocks)
        start = F.struct(F.lit(None).cast(unit_type).alias("open"), F.array().cast(done_type).alias("done"))
        chain = F.aggregate(
            # Large documents first: they settle by moving words to smaller ones, so what stays open is small.
            F.reverse(F.array_sort(F.collect_list(F.struct("w", "k", "p")))),
            start,
            lambda state, new: _meet(state, new, seed + level, F.array().cast(done_type)),
        )
        done = landed(
            units.groupBy("source", "n", block.alias("block")).agg(chain.alias("chain")).select("source", "n", "chain.*"),
            "mixed-blocks",
        )
        settled.append(done.select(F.explode("done").alias("one")).select("one.*"))
        left = done.select("source", F.ceil(F.col("n") / BLOCK).alias("n"), "open.*")
        most = done.agg(F.max(F.ceil(F.col("n") / BLOCK))).first()[0]
        if most is None or most <= 1:
            last = left.select("k", (_uniform(F.col("k"), F.lit(seed - 1)) < F.col("p")).cast("int").alias("take"))
            return settled[0] if most is None else _union([*settled, last])
        units, level = left.select("source", "n", "w", "k", "p"), level + 1


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix(
    docs: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``keys``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``, a row for each of ``docs``.

    Sources in code-point order have the weights in turn and share ``share`` of all words; none
    takes more than ``most`` times its size, which is also the most copies of a document.
    """
    key = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)]).alias("key")
    sized = landed(
        docs.select(key, F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size")),
        "mixed-sizes",
    )
    targets = landed(source_targets(sized, weights, share, most), "mixed-targets")
    wish = targets.withColumnRenamed("source", "of_source")
    # Rows that agree in everything are one unit of their number.
    units = sized.groupBy("key", "source", "size").agg(F.count("*").alias("rows"))
    units = units.join(wish, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")
    base, wanted = F.floor("wish"), F.col("rows") * (F.col("wish") - F.floor("wish"))
    units = landed(
        units.withColumn("base", base)
        .withColumn("whole", F.floor(wanted))
        .withColumn("p", wanted - F.floor(wanted))
        .withColumn("k", F.struct(F.col("key"), F.col("size"), F.xxhash64("source").alias("s"))),
        "mixed-units",
    )
    open_units = units.where("size > 0 and p > 0").select(
        "source", F.col("source_rows").alias("n"), F.col("size").cast("double").alias("w"), "k", "p"
    )
    drawn = _round(open_units, seed)
    extra = F.col("whole") + F.coalesce("take", F.lit(0))
    copies = F.col("base") + (F.col("number") <= extra).cast("long")
    return (
        units.join(drawn.hint("merge"), "k", "left")  # as many as documents: never to be broadcast by an estimate
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("number"))
        .select(
            *[F.col(f"key.k{i}").alias(c) for i, c in enumerate(keys)],
            "source",
            "size",
            "source_size",
            "target",
            copies.alias("copies"),
            (F.col("size") * copies).alias("taken"),
        )
    )
