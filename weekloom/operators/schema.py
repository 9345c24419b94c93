"""Column selection, required columns, type coercion and schema reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.columns import IDENTITY_COLUMNS, RETAIL


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def drop_columns(df: DataFrame, columns: Sequence[str] = IDENTITY_COLUMNS) -> DataFrame:
    """Drop identity columns; those absent are ignored."""
    return df.drop(*columns)


def require_columns(df: DataFrame, columns: Sequence[str] = tuple(RETAIL.required)) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    return df


def coerce_types(df: DataFrame, types: Mapping[str, str] = RETAIL.required) -> DataFrame:
    """Cast the required columns; a value that does not fit becomes null."""
    require_columns(df, tuple(types))
    return df.withColumns({c: F.col(quoted(c)).try_cast(t) for c, t in types.items()})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def one_row_per(measures: Mapping[str, Mapping[str, Column]], label: str = "column") -> Column:
    """Explode one aggregated row into one row per label.

    ``measures`` maps each label to its named values. All measures can then be
    computed by a single ``agg``.
    """
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in values.items()])
                for name, values in measures.items()
            ]
        )
    )


def aggregate_columns(
    df: DataFrame,
    measures: Mapping[str, Mapping[str, Column]],
    label: str = "column",
    constants: Mapping[str, Mapping[str, Column]] | None = None,
) -> DataFrame:
    """Aggregate every measure of every column in one pass, one result row per column.

    ``constants`` are put in after the aggregate, so they are there without rows too.
    """
    if not measures:
        raise ValueError("no columns to aggregate")
    names = {(c, m): f"{i}_{m}" for i, c in enumerate(measures) for m in measures[c]}
    row = df.agg(*[measures[c][m].alias(name) for (c, m), name in names.items()])
    fixed = constants or {}
    return row.select(
        one_row_per({c: {**fixed.get(c, {}), **{m: F.col(names[c, m]) for m in measures[c]}} for c in measures}, label)
    )


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name and type of each column, with its filled and empty cells."""
    counts, rows, filled = cell_counts(df, df.columns)
    return counts.select(
        one_row_per(
            {
                f.name: {
                    "position": F.lit(i),
                    "type": F.lit(f.dataType.simpleString()),
                    "filled": filled[f.name],
                    "empty": rows - filled[f.name],
                }
                for i, f in enumerate(df.schema.fields, start=1)
            }
        )
    )


def cell_counts(
    df: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, Column, dict[str, Column]]:
    """One row of counts, with the columns that hold its rows and its filled cells."""
    names = {c: f"filled_{i}" for i, c in enumerate(columns)}
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(quoted(c)).alias(n) for c, n in names.items()]
    )
    return counts, F.col("rows"), {c: F.col(n) for c, n in names.items()}


def type_check(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Expected against actual type, and how many values would be lost by a cast."""
    require_columns(df, tuple(expected))
    actual = {c: df.schema[c].dataType.simpleString() for c in expected}
    return aggregate_columns(
        df,
        {
            c: {"rejected": rejected(F.col(quoted(c)), t)} for c, t in expected.items()
        },
        constants={
            c: {"expected": F.lit(t), "actual": F.lit(actual[c]), "ok": F.lit(actual[c] == t)}
            for c, t in expected.items()
        },
    )


def rejected(c: Column, target: str | Column) -> Column:
    """How many non-null values a cast (or another conversion) turns into null."""
    converted = c.try_cast(target) if isinstance(target, str) else target
    return F.count_if(c.isNotNull() & converted.isNull())


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(quoted(column)).isNull())


def filled_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(quoted(column)).isNotNull())


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def stack_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns some frames lack become null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
