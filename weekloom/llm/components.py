"""Connected components of a table of links, by alternating large and small stars.

Every step is joins and minima over the links, so a node with very many links is reduced before
it is shuffled, and no list of neighbours is ever built. A step's links are written to the shared
folder; the number of steps grows with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.storage import landed


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node that is not
    its own root. ``links`` has columns ``a`` and ``b`` of any orderable type; direction, repeats
    and links of a node to itself don't matter, nulls are left out."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        links = landed(_small_star(_large_star(links)), "links")
        inner = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        several = links.groupBy("a").count().where("count > 1").select("a")
        if inner.select("a").union(several).isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
