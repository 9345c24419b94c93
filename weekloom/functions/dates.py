"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.columns import DATE_FORMAT

GRAINS = ("day", "week", "month")


def parse_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    """Parse text such as ``1/5/2024`` or ``01/05/2024``; anything else is null."""
    return F.try_to_date(c, fmt)


def as_date(c: Column, dtype: T.DataType | None = None, fmt: str = DATE_FORMAT) -> Column:
    """Text is parsed, in the format or as an ISO date with all its parts; dates and timestamps are cast."""
    if isinstance(dtype, T.StringType):
        iso = F.when(c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"), c.try_cast("date"))
        return F.coalesce(parse_date(c, fmt), iso)
    return c.cast("date")


def period_start(c: Column, grain: str = "week") -> Column:
    """First day of the day, week (Monday) or month."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {', '.join(GRAINS)}: {grain}")
    day = c.cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def week_start(c: Column) -> Column:
    return period_start(c, "week")


def date_parts(c: Column) -> dict[str, Column]:
    """ISO week number next to calendar month, year and quarter.

    The ISO week and the calendar year disagree around New Year, see ``iso_year``.
    """
    return {
        "week_of_year": F.weekofyear(c),
        "month": F.month(c),
        "year": F.year(c),
        "quarter": F.quarter(c),
    }


def iso_year(c: Column) -> Column:
    """The year the ISO week number belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), c)


def date_names(c: Column) -> dict[str, Column]:
    """Full weekday and month names, and a label such as ``2021-W53`` for the week."""
    return {
        "day_name": F.date_format(c, "EEEE"),
        "week_name": F.concat(
            F.lpad(iso_year(c).cast("string"), 4, "0"),
            F.lit("-W"),
            F.lpad(F.weekofyear(c).cast("string"), 2, "0"),
        ),
        "month_name": F.date_format(c, "MMMM"),
    }
