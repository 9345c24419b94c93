"""Run catalog queries next to their SQL and compare the results cell by cell."""

from __future__ import annotations

import datetime
import pathlib
import re

import duckdb


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def cell(value):
    """One comparable form per value; types must agree up to integer width."""
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return f"int {value}"
    if isinstance(value, float):
        return "nan" if value != value else f"float {value!r}"
    if isinstance(value, datetime.datetime):
        return f"timestamp {value.isoformat()}"
    if isinstance(value, datetime.date):
        return f"date {value.isoformat()}"
    return f"{type(value).__name__} {value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    actual_rows = [tuple(row) for row in spark_df.collect()]
    found = []
    if sorted(names) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} instead of {sorted(names)}")
        return found
    expected, actual = rows_of(names, expected_rows), rows_of(spark_df.columns, actual_rows)
    if len(expected) != len(actual):
        found.append(f"{len(actual)} rows instead of {len(expected)}")
    for a, e in zip(actual, expected):
        if a != e:
            found.append(f"{a} instead of {e}")
    return found


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def unwanted_in_plan(df) -> list[str]:
    """Operators that would not survive a large table."""
    text = plan(df)
    names = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas")
    found = [name for name in names if name in text]
    # Below the sort of a window is its exchange.
    if re.search(r"Window .*\n.*Sort .*\n.*Exchange SinglePartition", text):
        found.append("window in a single task")
    return found
