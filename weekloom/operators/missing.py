"""Missing values: shares, constant and mode fills, and the policy that picks one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.columns import RETAIL, SalesColumns
from weekloom.operators.forward_fill import forward_fill
from weekloom.operators.regression import fill_with_model, fit_sales_model
from weekloom.operators.schema import cell_counts, drop_null_rows, one_row_per, quoted


@dataclass(frozen=True)
class DropOrForwardFill:
    """Drop the rows below ``threshold`` percent of nulls, else fill forward."""

    threshold: float = 5


@dataclass(frozen=True)
class ConstantOrMode:
    """Fill with ``constant`` above ``threshold`` percent of nulls, else with the mode."""

    threshold: float
    constant: str


@dataclass(frozen=True)
class Regression:
    """Fill by a linear model on ``features``; ``solver`` as of ``fit_sales_model``."""

    features: Sequence[str]
    solver: str = "auto"


Rule = DropOrForwardFill | ConstantOrMode | Regression


def default_policy(columns: SalesColumns = RETAIL) -> dict[str, Rule]:
    # Thresholds in percent and fill words.
    return {
        columns.date: DropOrForwardFill(5),
        columns.city: ConstantOrMode(5, "Unknown"),
        columns.category: ConstantOrMode(1, "UnCategorized"),
        columns.sales: Regression((columns.city, columns.category)),
    }


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls per column."""
    counts, rows, filled = cell_counts(df, df.columns)
    return counts.select(*[(rows - filled[c]).alias(c) for c in df.columns])


def null_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls and percent of nulls per column; the share of an empty table is null."""
    counts, rows, filled = cell_counts(df, df.columns if columns is None else columns)
    return counts.select(
        one_row_per(
            {
                c: {
                    "rows": rows,
                    "nulls": rows - f,
                    "share": F.try_divide(F.lit(100.0) * (rows - f), rows),
                }
                for c, f in filled.items()
            }
        )
    )


def fill_constant(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(quoted(column)), F.lit(value)))


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column; ties go to the smallest, nulls do not count.

    One scan for all columns. The counts are reduced before and after the
    shuffle, so a value that holds a third of the rows moves as a few rows.
    """
    if not columns:
        return {}
    counted = (
        df.select(*[quoted(c) for c in columns])
        .groupingSets([[F.col(quoted(c))] for c in columns], *[F.col(quoted(c)) for c in columns])
        .agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"))
    )
    best = counted.groupBy("__set").agg(
        *[
            F.min(
                F.when(
                    F.col(quoted(c)).isNotNull(),
                    F.struct((-F.col("__n")).alias("order"), F.col(quoted(c)).alias("value")),
                )
            ).alias(f"__best_{i}")
            for i, c in enumerate(columns)
        ]
    )
    row = best.agg(*[F.min(f"__best_{i}").alias(f"__best_{i}") for i in range(len(columns))]).first()
    return {c: row[i]["value"] for i, c in enumerate(columns) if row[i] is not None}


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """Fill with the most frequent value; a column without values stays null."""
    found = modes(df, [column])
    return fill_constant(df, column, found[column]) if column in found else df


def apply_policy(
    df: DataFrame,
    policy: Mapping[str, Rule] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Treat the nulls of each column by its rule, in the order of the schema.

    Rows a rule drops no longer count for the columns after it. The shares on
    either side of a drop come from one pass over the table, the modes from a
    second one, and a model, if there is anything to predict, from a third.
    ``order_by`` is needed only when a forward fill is due.
    """
    policy = default_policy() if policy is None else policy
    shares = _shares(df, [c for c in df.columns if c in policy], policy)
    found = _modes_due(df, shares, policy)
    # The same rows without the forward fills, which a model on other columns need not repeat.
    plain, forward = df, set()
    for column, share in shares.items():
        rule = policy[column]
        if not share.nulls:
            continue
        if isinstance(rule, DropOrForwardFill):
            if share.percent < rule.threshold:
                df, plain = drop_null_rows(df, [column]), drop_null_rows(plain, [column])
            else:
                df = forward_fill(df, column, order_by, rows=share.rows)
                forward.add(column)
        elif isinstance(rule, ConstantOrMode):
            value = rule.constant if share.percent > rule.threshold else found.get(column)
            if value is not None:
                df, plain = fill_constant(df, column, value), fill_constant(plain, column, value)
        elif share.nulls < share.rows:
            base = df if forward & {column, *rule.features} else plain
            model = fit_sales_model(base, column, rule.features, rule.solver)
            df = fill_with_model(df, model, column)
            plain = fill_with_model(plain, model, column)
    return df


@dataclass(frozen=True)
class _Share:
    rows: int
    nulls: int
    dropped_before: tuple[str, ...]

    @property
    def percent(self) -> float:
        return 100 * self.nulls / self.rows


def _shares(df: DataFrame, columns: Sequence[str], policy: Mapping[str, Rule]) -> dict[str, _Share]:
    """Nulls of each column among the rows that the rules before it leave.

    Each pass counts twice: among all rows, and among those the first rule that
    may drop rows would leave. One pass is enough unless several such rules do.
    """
    shares: dict[str, _Share] = {}
    dropped: tuple[str, ...] = ()
    left = list(columns)
    while left:
        may_drop = [c for c in left if isinstance(policy[c], DropOrForwardFill)][:1]
        kept = F.col(quoted(may_drop[0])).isNotNull() if may_drop else F.lit(True)
        row = df.agg(
            F.struct(F.count(F.lit(1)), *[F.count(quoted(c)) for c in left]),
            F.struct(F.count_if(kept), *[F.count(F.when(kept, F.col(quoted(c)))) for c in left]),
        ).first()
        counts = row[0]
        for position, column in enumerate(left, start=1):
            shares[column] = share = _Share(counts[0], counts[0] - counts[position], dropped)
            rule = policy[column]
            if isinstance(rule, DropOrForwardFill) and share.nulls:
                if share.percent < rule.threshold:
                    dropped += (column,)
                    if column not in may_drop:
                        break
                    counts = row[1]
        left = left[position:]
        df = drop_null_rows(df, dropped) if dropped else df
    return shares


def _modes_due(df: DataFrame, shares: Mapping[str, _Share], policy: Mapping[str, Rule]):
    """Modes of the columns that fill with theirs, one pass per set of dropped rows."""
    due: dict[tuple[str, ...], list[str]] = {}
    for column, share in shares.items():
        rule = policy[column]
        if isinstance(rule, ConstantOrMode) and share.nulls and share.percent <= rule.threshold:
            due.setdefault(share.dropped_before, []).append(column)
    found = {}
    for dropped, columns in due.items():
        found |= modes(drop_null_rows(df, dropped) if dropped else df, columns)
    return found
