"""SQL text of column expressions.

A wide table is projected or aggregated with one call to Spark this way; built from Column
objects it takes several calls per column, which for thousands of columns is minutes of driver
time before any job starts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Java's number parser also takes "1d" or "0x1p3"; a data file means text by those.
NUMBER_PATTERN = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[iI]nf(?:inity)?|[nN]a[nN])\s*$"


def tick(name: str) -> str:
    """A column by its exact name, also when it holds dots, spaces or quotes."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(expression: str, name: str) -> str:
    return f"{expression} AS {tick(name)}"


def matches(c: str, pattern: str) -> str:
    return f"{c} RLIKE r'{pattern}'"


def nan_to_null(c: str) -> str:
    return f"nullif({c}, double('NaN'))"


def finite_or_null(c: str) -> str:
    """NULL for NaN and for both infinities. NaN sorts above infinity."""
    return f"CASE WHEN abs({c}) < double('Infinity') THEN {c} END"


def text_to_number(c: str, kind: str = "double") -> str:
    """The number a text holds, NULL when it holds none. Never raises under ANSI."""
    return f"CASE WHEN {matches(c, NUMBER_PATTERN)} THEN try_cast({c} AS {kind}) END"


def pearson(a: str, b: str) -> str:
    """Aggregate: correlation over the rows where both are known; NULL when one is constant."""
    x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS double) END"
    y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS double) END"
    return f"try_divide(covar_pop({x}, {y}), stddev_pop({x}) * stddev_pop({y}))"


def aggregate(df: DataFrame, measures: Mapping[str, str], key: str | None = None) -> DataFrame:
    """``measures`` by name, per ``key`` or over the whole table."""
    packed = F.expr("struct(" + ", ".join(named(sql, name) for name, sql in measures.items()) + ") AS _measures")
    if key is None:
        return df.agg(packed).selectExpr("_measures.*")
    return df.groupBy(tick(key)).agg(packed).selectExpr(tick(key), "_measures.*")


def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.selectExpr(*[tick(c) for c in names])
