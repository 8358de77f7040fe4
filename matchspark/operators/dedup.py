"""Duplicate rows and duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.functions.text import named, tick
from matchspark.operators.columns import quoted


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Equal rows once. Copies are folded on the map side, so many of them cost little."""
    return df.dropDuplicates()


def first_per_key(df: DataFrame, key: str = "ID", order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order_by``, ties broken by the remaining columns.

    This is an aggregate, not a window: each task first folds its own rows to one per key, so a
    key that holds a large share of the table never gathers in one task. Rows without a key
    go. Exact duplicates fold as well.
    """
    absent = [c for c in order_by if c not in df.columns]
    if absent:
        raise ValueError(f"unknown tiebreak columns {absent}")
    rest = [*order_by, *[c for c in df.columns if c != key and c not in order_by]]
    known = df.where(quoted(key).isNotNull())
    if not rest:
        return known.distinct()
    row = F.expr(f"min(struct({', '.join(map(tick, rest))})) AS _row")
    firsts = known.groupBy(quoted(key)).agg(row)
    return firsts.selectExpr(*[tick(c) if c == key else named(f"_row.{tick(c)}", c) for c in df.columns])


def key_counts(df: DataFrame, key: str = "ID") -> DataFrame:
    return df.where(quoted(key).isNotNull()).groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, key: str = "ID") -> DataFrame:
    return key_counts(df, key).where("n > 1")


def uniqueness_report(tables: dict[str, DataFrame], key: str = "ID") -> DataFrame:
    """Rows, distinct keys and whether the key is unique, one row per table."""
    reports = [
        df.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("n_rows"), F.count(quoted(key)).alias("distinct_ids"))
        .select(
            F.lit(name).alias("dataset"),
            F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
            "distinct_ids",
            (F.coalesce("n_rows", F.lit(0)) == F.col("distinct_ids")).alias("is_unique"),
        )
        for name, df in tables.items()
    ]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def require_unique(df: DataFrame, key: str = "ID", what: str = "table") -> DataFrame:
    """Raise if a key occurs twice; the check stops at the first one found."""
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"{what} has more than one row for some {key}")
    return df


def removed_counts(df: DataFrame, key: str = "ID") -> DataFrame:
    """Rows before, exact duplicates, further rows of a repeated key, rows kept, in one row."""
    per_row = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    per_key = per_row.groupBy(quoted(key)).agg(
        F.sum("_copies").alias("copies"), F.count(F.lit(1)).alias("variants")
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.coalesce(F.sum(F.col("copies") - F.col("variants")), F.lit(0)).cast("bigint").alias("exact_duplicates"),
        F.coalesce(F.sum(F.col("variants") - 1), F.lit(0)).cast("bigint").alias("repeated_keys"),
        F.count(F.lit(1)).alias("rows_after"),
    )
