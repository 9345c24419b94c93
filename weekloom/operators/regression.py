"""Regression fill: linear model on categories.

Up to ``NORMAL_LIMIT`` categories the model is Spark's own, on one-hot vectors, and prediction is a projection.
Beyond, effects are fitted by conjugate gradients over the cells, and looked up by joins for the rows to fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.columns import RETAIL
from weekloom.functions.numbers import average
from weekloom.operators.least_squares import CategoryEffects, fit_category_effects, predicted
from weekloom.operators.schema import quoted
from weekloom.shared import materialise

#: Categories of all features together, by solver.
NORMAL_LIMIT, LABEL_LIMIT = 4_000, 1_000_000
_LABEL, _WEIGHT, _GUESS, _ROW = "__label", "__weight", "__guess", "__row"


def fit_sales_model(
    df: DataFrame,
    target: str = RETAIL.sales,
    features: Sequence[str] = (RETAIL.city, RETAIL.category),
    solver: str = "auto",
    max_iter: int = 1000,
) -> PipelineModel | CategoryEffects:
    """Least squares of ``target`` on the categories of ``features``.

    All rows of one combination of categories share a prediction, so the mean of
    a combination, weighted by its rows, carries all the fit needs. The solver
    iterates over that small table rather than over the sales.

    ``solver`` is ``normal`` (normal equations, up to ``NORMAL_LIMIT`` categories together), ``l-bfgs`` (up to
    ``LABEL_LIMIT``, as labels are kept on the driver and in each task), ``cells`` (conjugate gradients over the
    stored combinations, without a limit), or ``auto``: the first or the last of these, by the number of categories.
    A solver that stops before it converges raises.
    """
    cells = materialise(
        df.where(F.col(quoted(target)).isNotNull())
        .groupBy(*[quoted(c) for c in features])
        .agg(
            average(F.col(quoted(target))).alias(_LABEL),
            F.count(F.lit(1)).cast("double").alias(_WEIGHT),
        ),
        "sales-cells",
    )
    if solver != "cells":
        # More categories than the limit need not be counted exactly.
        few = cells.agg(*[F.approx_count_distinct(F.col(quoted(c))) for c in features]).first()
        size = sum(few)
        if size <= 2 * LABEL_LIMIT:
            size = sum(cells.agg(*[F.count_distinct(F.col(quoted(c))) for c in features]).first())
        if solver == "auto":
            solver = "normal" if size <= NORMAL_LIMIT else "cells"
        limit = NORMAL_LIMIT if solver == "normal" else LABEL_LIMIT
        if solver != "cells" and size > limit:
            raise ValueError(f"{size} categories are too many for the solver {solver}: at most {limit}")
    if solver == "cells":
        return fit_category_effects(cells, features, _LABEL, _WEIGHT, max_iter=max_iter)
    model = _stages(features, solver, max_iter).fit(cells)
    iterations = model.stages[-1].summary.totalIterations
    if iterations >= max_iter:
        raise RuntimeError(f"the solver {solver} did not converge in {max_iter} iterations")
    return model


def _stages(features: Sequence[str], solver: str, max_iter: int) -> Pipeline:
    indices = [f"__index_{i}" for i in range(len(features))]
    vectors = [f"__vector_{i}" for i in range(len(features))]
    return Pipeline(
        stages=[
            # "keep": a category first met among the rows to fill must not fail.
            StringIndexer(inputCols=list(features), outputCols=indices, handleInvalid="keep"),
            OneHotEncoder(inputCols=indices, outputCols=vectors),
            VectorAssembler(inputCols=vectors, outputCol="__features"),
            LinearRegression(
                featuresCol="__features",
                labelCol=_LABEL,
                weightCol=_WEIGHT,
                predictionCol=_GUESS,
                solver=solver,
                tol=1e-12,
                maxIter=max_iter,
            ),
        ]
    )


def fill_with_model(df: DataFrame, model: PipelineModel | CategoryEffects, target: str = RETAIL.sales) -> DataFrame:
    """Put the prediction where ``target`` is null.

    With Spark's model rows are neither split nor moved. With effects only the rows to fill are joined
    with them; the others pass by.
    """
    dtype = df.schema[target].dataType
    if isinstance(model, CategoryEffects):
        empty = predicted(df.where(F.col(quoted(target)).isNull()), model)
        filled = [(F.col("guess").cast(dtype) if c == target else F.col(f"row.{quoted(c)}")).alias(c) for c in df.columns]
        return df.where(F.col(quoted(target)).isNotNull()).unionByName(empty.select(*filled))
    # The model gets the categories alone, so that its columns meet no others.
    stages = model.stages[0].getInputCols()
    whole = df.select(F.struct(*[quoted(c) for c in df.columns]).alias(_ROW), *[F.col(quoted(c)) for c in stages])
    guess = F.coalesce(F.col(f"{_ROW}.{quoted(target)}"), F.col(_GUESS).cast(dtype))
    return model.transform(whole).select(
        *[(guess if c == target else F.col(f"{_ROW}.{quoted(c)}")).alias(c) for c in df.columns]
    )


def predict_missing_sales(
    df: DataFrame,
    target: str = RETAIL.sales,
    features: Sequence[str] = (RETAIL.city, RETAIL.category),
    solver: str = "auto",
) -> DataFrame:
    """Fill null sales by regression; a table without nulls or without sales is unchanged."""
    counts = df.agg(
        F.count_if(F.col(quoted(target)).isNull()).alias("empty"),
        F.count(quoted(target)).alias("filled"),
    ).first()
    if not counts["empty"] or not counts["filled"]:
        return df
    return fill_with_model(df, fit_sales_model(df, target, features, solver), target)
