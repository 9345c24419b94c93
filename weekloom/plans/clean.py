"""Cleaning: from raw rows to tidy, coerced and capped sales."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.columns import IDENTITY_COLUMNS, RETAIL, SalesColumns
from weekloom.functions.text import tidy
from weekloom.operators.dedup import deduplicate, drop_duplicates
from weekloom.operators.missing import Rule, apply_policy, default_policy
from weekloom.operators.schema import drop_columns, quoted


def tidy_columns(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    return df.withColumns({c: tidy(F.col(quoted(c)), **options) for c in columns})


@dataclass(frozen=True)
class Cleaned:
    """The rows, and one row with the duplicates that were dropped (``duplicate_groups``, ``surplus_rows``)."""

    rows: DataFrame
    duplicates: DataFrame


def clean(df: DataFrame, columns: SalesColumns = RETAIL, *args, **options) -> DataFrame:
    """The rows of ``clean_with_report``. Without the report duplicates are dropped lazily, and rows move once."""
    filled, keys, tidied = _filled(df, columns, *args, **options)
    return tidied(drop_duplicates(filled, keys))


def clean_with_report(df: DataFrame, columns: SalesColumns = RETAIL, *args, **options) -> Cleaned:
    """Drop identity columns, treat nulls, drop duplicates, tidy the text columns. See ``_filled`` for the options.

    The duplicates' report and what to drop come from one count of digests; only rows whose digest repeats move.
    """
    filled, keys, tidied = _filled(df, columns, *args, **options)
    made = deduplicate(filled, keys)
    return Cleaned(tidied(made.rows), made.report)


def _filled(
    df: DataFrame,
    columns: SalesColumns,
    identity: Sequence[str] = IDENTITY_COLUMNS,
    policy: Mapping[str, Rule] | None = None,
    order_by: Sequence[str] = (),
    dedup_keys: Sequence[str] | None = None,
    retrim: bool = False,
) -> tuple[DataFrame, Sequence[str] | None, Callable[[DataFrame], DataFrame]]:
    """The rows up to the search for duplicates, the columns to compare, and what follows it.

    Sales are cast before their nulls are looked at, so what is no number is filled
    like a missing one; ``rejects`` counts it.

    Duplicates are looked for once the identity columns are gone and before the
    text is tidied; ``dedup_keys`` compares only those columns. Columns named in
    ``order_by`` serve a forward fill and stay until it is done.
    """
    ordering = [c for c in order_by if c in identity]
    kept = drop_columns(df, [c for c in identity if c not in ordering])
    if columns.sales in kept.columns:
        kept = kept.withColumn(columns.sales, F.col(quoted(columns.sales)).try_cast(columns.required[columns.sales]))
    filled = drop_columns(apply_policy(kept, policy or default_policy(columns), order_by), ordering)
    return filled, dedup_keys, lambda rows: tidy_columns(rows, [columns.city, columns.category], retrim=retrim)
