"""Calendar spine and gaps in a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.columns import RETAIL
from weekloom.functions.dates import period_start
from weekloom.operators.aggregate import date_bounds
from weekloom.operators.schema import quoted

# One period of each grain.
_STEPS = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month"}


def spine(
    df: DataFrame, date: str = RETAIL.week, by: Sequence[str] = (), grain: str = "week"
) -> DataFrame:
    """Every period between the first and last date, of the table or of each key."""
    first, last = (period_start(F.col(c), grain) for c in ("first_date", "last_date"))
    return date_bounds(df, date, by).select(
        *[quoted(c) for c in by],
        F.explode(F.sequence(first, last, F.expr(_STEPS[grain]))).alias(date),
    )


def missing_periods(
    df: DataFrame, date: str = RETAIL.week, by: Sequence[str] = (), grain: str = "week"
) -> DataFrame:
    """Periods of the spine without any row.

    The rows are read once and reduced to their distinct periods; each key's
    periods then fit an array, as there are no more of them than the calendar has.
    """
    keys = [quoted(c) for c in by]
    period = period_start(F.col(quoted(date)), grain)
    present = (
        df.select(*keys, period.alias("__period"))
        .distinct()
        .groupBy(*keys)
        .agg(F.collect_list("__period").alias("__present"))
    )
    every = F.sequence(
        F.array_min("__present"), F.array_max("__present"), F.expr(_STEPS[grain])
    )
    return present.select(*keys, F.explode(F.array_except(every, "__present")).alias(date))


def ensure_continuity(
    df: DataFrame,
    date: str = RETAIL.week,
    by: Sequence[str] = (),
    grain: str = "week",
    flag: str = "is_missing",
) -> DataFrame:
    """The rows on the spine, plus a flagged row with nulls for each period without any.

    This is the left join of the spine with the rows, without moving the rows:
    only their distinct periods are shuffled. Rows without a date are on no
    period and drop out, as in the join.
    """
    rows = df.where(F.col(quoted(date)).isNotNull()).withColumn(
        date, period_start(F.col(quoted(date)), grain)
    )
    gaps = missing_periods(rows, date, by, grain).withColumn(flag, F.lit(True))
    return rows.withColumn(flag, F.lit(False)).unionByName(gaps, allowMissingColumns=True)
