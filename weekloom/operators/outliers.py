"""Quartiles, interquartile fences and capping."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.operators.schema import aggregate_columns, numeric_columns, one_row_per, quoted
from weekloom.shared import materialise

# Quartiles and the width of the fences.
QUARTILES = (0.25, 0.75)
FENCE_WIDTH = 1.5
#: Values of a bracket that are ranked in one task, and ranges of a larger one, at most.
RANGE_VALUES, MOST_RANGES = 2_000, 2_000
APPROXIMATE_ACCURACY = 10_000


def _double(column: str) -> Column:
    """A column as numbers. NaN is a missing value: no quantile, fence or count sees it."""
    return F.nanvl(F.col(quoted(column)).cast("double"), F.lit(None).cast("double"))


def quantiles_approx(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = APPROXIMATE_ACCURACY,
) -> DataFrame:
    """One row per column and probability, all from one pass without a shuffle of rows.

    The rank of a result is off by at most ``1 / accuracy`` of the rows.
    """
    wide = aggregate_columns(
        df,
        {
            c: {
                "values": F.percentile_approx(
                    _double(c), [float(p) for p in probabilities], accuracy
                )
            }
            for c in columns
        },
    )
    at = {f"{p}": {"p": F.lit(float(p)), "value": F.get("values", F.lit(i))} for i, p in enumerate(probabilities)}
    return wide.select("column", one_row_per(at, "label")).select("column", "p", "value")


@dataclass(frozen=True)
class _Bracket:
    """Values of a column that are sure to contain one of its quantiles."""

    column: str
    p: float
    low: float
    high: float
    first_rank: int  # of the two values around the quantile, counted inside the bracket
    last_rank: int
    share: float  # how far the quantile lies from the first to the second


def quantiles_exact(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = APPROXIMATE_ACCURACY,
) -> DataFrame:
    """As ``quantiles_approx``, but exact, with linear interpolation between ranks.

    A sketch brackets each quantile, and one pass counts the values below and in
    each bracket. From then on only the few rows in a bracket matter. Its different values
    are cut into ranges at sampled ones, whatever their distribution, and only in the ranges that hold a wanted
    rank are values ranked one by one: no task sees all values of a column.
    """
    brackets = _brackets(df, columns, probabilities, accuracy)
    empty = [c for c in columns if c not in {b.column for b in brackets}]
    # A column without values has null quantiles either way.
    nothing = quantiles_approx(df, empty, probabilities) if empty else None
    if not brackets:
        return nothing
    inside = [_double(b.column).between(F.lit(b.low), F.lit(b.high)) for b in brackets]
    cells = (
        df.where(reduce(Column.__or__, inside))
        .select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("b"),
                            F.when(inside[i], _double(b.column)).alias("value"),
                        )
                        for i, b in enumerate(brackets)
                    ]
                )
            )
        )
        .where(F.col("value").isNotNull())
    )
    cells = _ranged(cells.groupBy("b", "value").agg(F.count(F.lit(1)).alias("n")))

    def of_bracket(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("b"))

    ranks = F.array(
        of_bracket([b.first_rank for b in brackets]), of_bracket([b.last_rank for b in brackets])
    )
    wanted = (
        # One row per range of a bracket, of which one or two stay.
        cells.groupBy("b", "zone")
        .agg(F.sum("n").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("b").orderBy("zone")) - F.col("n"))
        .withColumn("rank", F.explode(F.array_distinct(ranks)))
        .withColumn("rank", F.col("rank") - F.col("before"))
        .where(F.col("rank").between(0, F.col("n") - 1))
        .select("b", "zone", "rank")
    )
    counted = (
        cells.join(F.broadcast(wanted.select("b", "zone").distinct()), ["b", "zone"], "left_semi")
        .withColumn("upto", F.sum("n").over(Window.partitionBy("b", "zone").orderBy("value")))
    )
    first, second = F.min("value"), F.max("value")
    share = of_bracket([b.share for b in brackets])
    exact = (
        counted.join(F.broadcast(wanted), ["b", "zone"])
        .where(F.col("rank").between(F.col("upto") - F.col("n"), F.col("upto") - 1))
        .groupBy("b")
        .agg(first.alias("first"), second.alias("second"))
        .select(
            of_bracket([b.column for b in brackets]).alias("column"),
            of_bracket([b.p for b in brackets]).alias("p"),
            F.when(F.col("first") == F.col("second"), F.col("first"))
            .otherwise((1 - share) * F.col("first") + share * F.col("second"))
            .alias("value"),
        )
    )
    return exact.unionByName(nothing) if nothing else exact


def _brackets(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int, widened: int = 1
) -> list[_Bracket]:
    """A bracket per column and probability; where the sketch missed, it is tried again more widely."""
    margin = min(1.0, 2 * widened / accuracy)
    bounds = [min(max(p + m, 0.0), 1.0) for p in probabilities for m in (-margin, margin)]
    if margin < 1:
        sketch = df.agg(*[F.percentile_approx(_double(c), bounds, accuracy) for c in columns]).first()
    else:
        # So wide a bracket holds all values; its ends need no sketch.
        ends = df.agg(*[F.array(F.min(_double(c)), F.max(_double(c))) for c in columns]).first()
        sketch = [e * len(probabilities) if e[0] is not None else None for e in ends]
    found = [
        (c, float(p), *sketch[i][2 * k : 2 * k + 2])
        for i, c in enumerate(columns)
        if sketch[i]
        for k, p in enumerate(probabilities)
    ]
    if not found:
        return []
    counts = df.agg(
        *[
            F.struct(
                F.count(_double(c)),
                F.count_if(_double(c) < low),
                F.count_if(_double(c) <= high),
            )
            for c, _, low, high in found
        ]
    ).first()
    brackets, missed = [], []
    for (c, p, low, high), (rows, below, upto) in zip(found, counts):
        position = p * (rows - 1)
        first, last = math.floor(position), math.ceil(position)
        if below <= first <= last < upto:
            brackets.append(_Bracket(c, p, low, high, first - below, last - below, position - first))
        else:
            missed.append((c, p))
    for c, p in missed:
        brackets += _brackets(df, [c], [p], accuracy, widened * 32)
    return brackets


def _ranged(counted: DataFrame) -> DataFrame:
    """Counted values (``b``, ``value``, ``n``), stored with the range of values, ``zone``, each is in."""
    counted = materialise(counted, "quantile-values")
    ranges = min(MOST_RANGES, counted.count() // RANGE_VALUES)
    if ranges <= 1:
        return counted.withColumn("zone", F.lit(0))
    cut = counted.repartitionByRange(ranges, "b", "value").withColumn("zone", F.spark_partition_id())
    return materialise(cut, "quantile-ranges")


def iqr_fences(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact", **options
) -> DataFrame:
    """Quartiles and fences per numeric column; null for a column without values."""
    quantiles = {"exact": quantiles_exact, "approx": quantiles_approx}[method]
    columns = numeric_columns(df) if columns is None else columns
    q1, q3 = (F.max(F.when(F.col("p") == p, F.col("value"))) for p in QUARTILES)
    width = F.lit(FENCE_WIDTH) * (F.col("q3") - F.col("q1"))
    return (
        quantiles(df, columns, QUARTILES, **options)
        .groupBy("column")
        .agg(q1.alias("q1"), q3.alias("q3"))
        .withColumns({"lower": F.col("q1") - width, "upper": F.col("q3") + width})
    )


def collect_fences(fences: DataFrame) -> dict[str, tuple[float, float]]:
    """Fences as numbers; there is one row per column."""
    return {
        row["column"]: (row["lower"], row["upper"])
        for row in fences.collect()
        if row["lower"] is not None
    }


#: Whole-number types and the largest value of each.
_WHOLE = {T.ByteType: 2**7, T.ShortType: 2**15, T.IntegerType: 2**31, T.LongType: 2**63}


def _fences(bounds: tuple[float, float], dtype: T.DataType) -> tuple[Column, Column]:
    """Both fences in a form that compares exactly with the column.

    Between whole numbers the fence is the last whole number inside; a decimal has
    an exact fence, which is null, and so met by no value, beyond 30 digits.
    """
    lower, upper = bounds
    if type(dtype) in _WHOLE:
        most = _WHOLE[type(dtype)]
        lower = min(max(math.ceil(lower), -most), most - 1) if math.isfinite(lower) else -most
        upper = min(max(math.floor(upper), -most), most - 1) if math.isfinite(upper) else most - 1
        return F.lit(lower).cast(dtype), F.lit(upper).cast(dtype)
    if isinstance(dtype, T.DecimalType):
        return tuple(F.lit(repr(bound)).try_cast("decimal(38,8)") for bound in bounds)
    return F.lit(lower), F.lit(upper)


def is_outlier(c: Column, lower: Column, upper: Column) -> Column:
    return (c < lower) | (c > upper)


def _numbers_only(c: Column, dtype: T.DataType) -> Column:
    """Without NaN, which Spark orders above all numbers, so that it would count as an outlier."""
    return F.nanvl(c, F.lit(None).cast(dtype)) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c


def outlier_counts(df: DataFrame, fences: dict[str, tuple[float, float]]) -> dict[str, Column]:
    """The number of values outside the fences, by column. They can be observed while rows are written."""
    counts = {}
    for column, bounds in fences.items():
        dtype = df.schema[column].dataType
        lower, upper = _fences(bounds, dtype)
        counts[column] = F.count_if(is_outlier(_numbers_only(F.col(quoted(column)), dtype), lower, upper))
    return counts


def outlier_report(
    df: DataFrame, fences: dict[str, tuple[float, float]], counted: Mapping[str, int] | None = None
) -> DataFrame:
    """Fences and number of values outside them, all columns in one pass, or in none if ``counted`` brings the numbers."""
    bounds = {c: {"lower": F.lit(float(low)), "upper": F.lit(float(high))} for c, (low, high) in fences.items()}
    if counted is None:
        counts = {c: {"outliers": count} for c, count in outlier_counts(df, fences).items()}
        return aggregate_columns(df, counts, constants=bounds).select("column", "lower", "upper", "outliers")
    rows = {c: {**bounds[c], "outliers": F.lit(counted[c]).cast("long")} for c in fences}
    return df.sparkSession.range(1).select(one_row_per(rows))


def cap_outliers(df: DataFrame, fences: dict[str, tuple[float, float]]) -> DataFrame:
    """Clamp each column to its fences; nulls and NaN stay what they are, and every column keeps its type."""
    capped = {}
    for column, bounds in fences.items():
        value, dtype = F.col(quoted(column)), df.schema[column].dataType
        lower, upper = _fences(bounds, dtype)
        number = _numbers_only(value, dtype)
        capped[column] = (
            F.when(number < lower, lower.try_cast(dtype)).when(number > upper, upper.try_cast(dtype)).otherwise(value)
        )
    return df.withColumns(capped)


def handle_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact", **options
) -> DataFrame:
    """Cap every numeric column to its interquartile fences."""
    columns = numeric_columns(df) if columns is None else columns
    if not columns:
        return df
    return cap_outliers(df, collect_fences(iqr_fences(df, columns, method, **options)))
