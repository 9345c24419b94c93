"""Least squares on categories, for any number of them, by conjugate gradients.

The model is a sum of one effect per feature, that of the row's category. All rows of one combination of
categories share a prediction, so the mean of such a cell, weighted by its rows, is all the fit needs. An
iteration looks the directions of a cell's categories up, and sums the cell's weighted total back to the
categories: joins and sums on the cells. No vector is ever held by the driver or a task; from an iteration
only two sums are.

Category ids are dense numbers from a distributed index. A category with very many cells is dealt
to several parts in the joins, and reduced before it is shuffled in the sums.

The cells don't move in an iteration, as a rule. They are stored in buckets of the feature with most categories, so
that only its directions are shuffled to them; features of at most ``MOST_BROADCAST`` categories are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.operators.indexing import dense_numbers, join_by_value
from weekloom.operators.schema import quoted
from weekloom.shared import materialise, shared_folder

#: Cells of one category that are joined by one task.
CELLS_PER_PART = 100_000
#: Cells of one bucket, about, and the most categories of a feature whose directions are broadcast: 2 MB of numbers.
CELLS_PER_BUCKET, MOST_BROADCAST = 1_000_000, 100_000


@dataclass(frozen=True)
class CategoryEffects:
    """``effects``: ``feature`` (position), ``value`` (as ``category_key``) and ``effect``; ``mean_effects``: of each feature,
    over all rows, for categories that were not met."""

    features: tuple[str, ...]
    effects: DataFrame
    mean_effects: tuple[float, ...]
    iterations: int


def category_key(column: str) -> Column:
    """A category as text. Null is a category of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(quoted(column)).cast("string")), F.lit(""))


def fit_category_effects(
    cells: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str,
    tolerance: float = 1e-12,
    max_iter: int = 500,
) -> CategoryEffects:
    """Fit ``label`` with ``weight`` on the categories of ``features``; one row of ``cells`` per combination.

    Stops when the residual of the normal equations, scaled by the categories' weights, has shrunk to ``tolerance``.
    On a design whose categories do not hang together, the solution is the one closest to no effects.
    """
    n = len(features)
    keyed = cells.select(
        *[category_key(c).alias(f"key{i}") for i, c in enumerate(features)],
        F.col(quoted(label)).cast("double").alias("y"),
        F.col(quoted(weight)).cast("double").alias("w"),
    )

    def per_category(of: DataFrame, category: str, **sums: Column) -> DataFrame:
        """Sums per feature and category; partial sums are formed before the one shuffle for all features."""
        stacked = F.inline(
            F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"{category}{i}").alias("at")) for i in range(n)])
        )
        totals = [F.sum(c).alias(name) for name, c in sums.items()]
        values = of.select("*", stacked)
        return values.groupBy("feature", "at").agg(*totals)

    totals = per_category(keyed, "key", d=F.col("w"), b=F.col("w") * F.col("y"), n_cells=F.lit(1).cast("long"))
    numbered = materialise(dense_numbers(totals, [F.col("feature"), F.col("at")], "j"), "categories")
    sizes = {r["feature"]: r for r in numbered.groupBy("feature").agg(F.count("*").alias("size"), F.sum("n_cells").alias("cells")).collect()}
    of_size = sorted(sizes, key=lambda i: sizes[i]["size"], reverse=True)
    keyed = keyed.drop("y")
    for i in of_size:
        of = numbered.where(F.col("feature") == i).select("at", F.col("j").alias(f"j{i}"), F.ceil(F.col("n_cells") / CELLS_PER_PART).cast("int").alias(f"m{i}"))
        if sizes[i]["size"] <= MOST_BROADCAST:
            keyed = keyed.join(F.broadcast(of), F.col(f"key{i}") == F.col("at")).drop("at", f"key{i}")
        else:
            keyed = join_by_value(keyed, of, F.col(f"key{i}")).drop(f"key{i}")
    row = F.monotonically_increasing_id()
    dealt = [F.pmod(F.col("row"), F.col(f"m{i}")).cast("int").alias(f"part{i}") for i in of_size]
    ids = [f"j{i}" for i in of_size]
    indexed = keyed.select(*ids, *[f"m{i}" for i in of_size], "w", row.alias("row")).select(*ids, *dealt, "w")
    indexed = _bucketed(indexed, [f"{c}{i}" for i in of_size[:1] for c in ("j", "part")], sizes[of_size[0]]["cells"] if sizes else 0)

    parts = F.ceil(F.col("n_cells") / CELLS_PER_PART).cast("int")
    state = numbered.select("feature", "j", "d", parts.alias("parts"), F.lit(0.0).alias("x"), F.col("b").alias("r"), (F.col("b") / F.col("d")).alias("p"))
    size = numbered.agg(F.sum(F.col("b") * F.col("b") / F.col("d"))).first()[0] or 0.0
    squared, iteration = size, 0
    while squared > tolerance * tolerance * size:
        if iteration >= max_iter:
            raise RuntimeError(f"conjugate gradients did not converge in {max_iter} iterations")
        iteration += 1
        step = indexed
        for i in of_size:
            of = state.where(F.col("feature") == i).select(F.col("j").alias(f"j{i}"), F.col("p").alias(f"p{i}"), "parts")
            if sizes[i]["size"] <= MOST_BROADCAST:
                step = step.join(F.broadcast(of.drop("parts")), f"j{i}")
                continue
            of = of.select(f"j{i}", f"p{i}", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias(f"part{i}"))
            step = step.join(of, [f"j{i}", f"part{i}"])
        total = sum((F.col(f"p{i}") for i in range(1, n)), F.col("p0"))
        image = per_category(step.withColumn("v", F.col("w") * total), "j", q=F.col("v")).select(F.col("at").alias("j"), "q")
        stepped = materialise(state.join(image, "j"), "conjugate-step")
        curvature = stepped.agg(F.sum(F.col("p") * F.col("q"))).first()[0]
        if not curvature:
            break
        alpha = squared / curvature
        r = F.col("r") - F.lit(alpha) * F.col("q")
        before, squared = squared, stepped.agg(F.sum(r * r / F.col("d"))).first()[0]
        state = stepped.select(
            "feature", "j", "d", "parts",
            (F.col("x") + F.lit(alpha) * F.col("p")).alias("x"),
            r.alias("r"),
            (r / F.col("d") + F.lit(squared / before) * F.col("p")).alias("p"),
        )
    effects = materialise(
        numbered.join(state.select("j", "x"), "j").select("feature", F.col("at").alias("value"), F.col("x").alias("effect"), F.col("d").alias("weight")),
        "category-effects",
    )
    means = effects.groupBy("feature").agg((F.sum(F.col("effect") * F.col("weight")) / F.sum("weight")).alias("mean")).collect()
    by_feature = {m["feature"]: m["mean"] for m in means}
    return CategoryEffects(tuple(features), effects, tuple(by_feature.get(i, 0.0) for i in range(n)), iteration)


def _bucketed(cells: DataFrame, columns: Sequence[str], n_cells: int) -> DataFrame:
    """``cells``, stored in buckets of ``columns`` and read back; without columns, just stored."""
    if not columns:
        return materialise(cells, "indexed-cells")
    spark, path = cells.sparkSession, shared_folder(cells.sparkSession, "indexed-cells")
    n = max(spark.sparkContext.defaultParallelism, -(-n_cells // CELLS_PER_BUCKET))
    name = f"weekloom_{path.rpartition('-')[2]}"
    dealt = cells.repartition(n, *columns)
    dealt.write.format("parquet").option("path", path).bucketBy(n, *columns).sortBy(*columns).saveAsTable(name)
    stored = spark.table(name)
    # The name alone: the files stay in the shared folder, like other intermediate tables.
    spark.sql(f"DROP TABLE {name}")
    return stored


def predicted(df: DataFrame, model: CategoryEffects) -> DataFrame:
    """The rows of ``df`` as a struct, ``row``, and ``guess``, the sum of the effects of each row's categories."""
    keys = [category_key(c).alias(f"key{i}") for i, c in enumerate(model.features)]
    out = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), *keys)
    for i in range(len(keys)):
        of = model.effects.where(F.col("feature") == i).select("value", F.col("effect").alias(f"effect{i}"))
        out = join_by_value(out, of, F.col(f"key{i}"))
    effects = [F.coalesce(F.col(f"effect{i}"), F.lit(mean)) for i, mean in enumerate(model.mean_effects)]
    return out.select("row", sum(effects[1:], effects[0]).alias("guess"))
