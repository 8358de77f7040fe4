"""Profiling reports. Each is one pass over the columns it needs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspark.functions.expressions import CLASS_NAMES
from matchspark.functions.text import aggregate, literal, named, pearson, tick
from matchspark.operators.columns import numeric_columns, quoted
from matchspark.operators.quantiles import exact_percentiles
from matchspark.operators.rollup import chunks, packed_chunks
from matchspark.session import cut_lineage

# Aggregates in one generated stage; beyond about this many the code no longer compiles well.
AGGREGATES_PER_STAGE = 32


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def column_measures(
    df: DataFrame,
    columns: Sequence[str],
    measures: dict[str, str],
    prepare: str = "CAST({} AS double)",
    carry: Sequence[str] = (),
    aggregates: int = AGGREGATES_PER_STAGE,
) -> DataFrame:
    """``feature`` and one column per aggregate measure, from a single pass.

    Measures are SQL with ``{}`` for the column. ``prepare`` brings all columns to one type;
    ``carry`` names columns the measures refer to besides their own. A wide table becomes one
    row per chunk of columns, so that one aggregate with few states serves every chunk; it
    folds on the map side to a row per chunk and task.
    """
    if not columns:
        raise ValueError("no columns to measure")
    width = max(1, aggregates // len(measures))
    batches = chunks(columns, width)
    width = len(batches[0])

    def texts(cell: Callable[[int], str]) -> dict[str, str]:
        return {f"{name}_{i}": sql.format(cell(i)) for i in range(width) for name, sql in measures.items()}

    def listed(name: Callable[[int], str]) -> str:
        parts = (", ".join(f"{m}_{i} AS {m}" for m in measures) for i in range(width))
        return "inline(array(" + ", ".join(f"struct({name(i)} AS feature, {p})" for i, p in enumerate(parts)) + "))"

    if len(batches) == 1:
        one_row = aggregate(df, texts(lambda i: prepare.format(tick(columns[i]))))
        return one_row.selectExpr(listed(lambda i: literal(columns[i])))
    pieces = packed_chunks(batches, prepare.format)
    rows = df.selectExpr(*map(tick, carry), f"posexplode({pieces}) AS (_pos, _cell)")
    folded = aggregate(rows, texts(lambda i: f"_cell.x{i}"), "_pos")
    names = ", ".join(f"{at}, array({', '.join(map(literal, batch))})" for at, batch in enumerate(batches))
    return folded.selectExpr("*", f"map({names})[_pos] AS _names").selectExpr(listed(lambda i: f"get(_names, {i})")).where(
        "feature IS NOT NULL"
    )


# -- missing values, types, constants -------------------------------------------------


def missing_ratio(df: DataFrame, key: str = "ID") -> DataFrame:
    columns = [c for c in df.columns if c != key]
    return column_measures(df, columns, {"missing_ratio": "coalesce(avg({}), 0.0D)"}, prepare="CAST({} IS NULL AS int)")


def top_missing(df: DataFrame, key: str = "ID", k: int = 30) -> DataFrame:
    """The columns with most missing values, of those that have any."""
    return (
        missing_ratio(df, key)
        .where("missing_ratio > 0")
        .orderBy(F.desc("missing_ratio"), "feature")
        .limit(k)
    )


def columns_with_missing(df: DataFrame, key: str = "ID") -> DataFrame:
    return missing_ratio(df, key).agg(
        F.count_if(F.col("missing_ratio") > 0).alias("with_missing"), F.count(F.lit(1)).alias("n_features")
    )


def feature_type_counts(tables: dict[str, DataFrame], key: str = "ID") -> DataFrame:
    """Features, numeric and other, per table. The schema answers it; no row is read."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        features = [c for c in df.columns if c != key]
        numeric = len(numeric_columns(df, [key]))
        rows.append((name, len(features), numeric, len(features) - numeric))
    return spark.createDataFrame(rows, "dataset string, n_features bigint, n_numeric bigint, n_other bigint")


def constant_columns(df: DataFrame, key: str = "ID") -> DataFrame:
    """``feature, is_constant``: at most one value, a missing value counting as one.

    A column is constant if no row differs from one row of the table. The comparison gives numbers,
    so the fold is a hash aggregate without a sort.
    """
    columns = [c for c in df.columns if c != key]
    fractional = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    # adding 0 makes -0.0 and 0.0 the same text
    as_text = [named(f"CAST({tick(c)}{' + 0.0D' if c in fractional else ''} AS string)", c) for c in columns]
    texts = df.selectExpr(*as_text)
    one = texts.first()
    if one is None:
        return df.sparkSession.createDataFrame([(c, True) for c in columns], "feature string, is_constant boolean")
    value = {c: "NULL" if one[i] is None else literal(one[i]) for i, c in enumerate(columns)}
    differs = [named(f"CAST({tick(c)} IS DISTINCT FROM {value[c]} AS int)", c) for c in columns]
    return column_measures(texts.selectExpr(*differs), columns, {"is_constant": "max({}) = 0"}, prepare="{}")


def drop_constant(train: DataFrame, *others: DataFrame, key: str = "ID") -> list[DataFrame]:
    names = [r["feature"] for r in constant_columns(train, key).where("is_constant").collect()]
    return [df.drop(*[c for c in names if c in df.columns]) for df in (train, *others)]


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct known values per column, from one scan.

    Exact counts go through (column, value) pairs, folded on the map side, not through one
    distinct aggregate per column. ``exact=False`` uses a sketch of fixed size.
    """
    if not exact:
        return column_measures(df, columns, {"n_distinct": "approx_count_distinct({})"}, prepare="CAST({} AS string)")
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).cast("string").alias("v")) for c in columns])
    pairs = df.select(F.inline(cells)).groupBy("feature", "v").agg(F.lit(1).alias("_one"))
    return pairs.groupBy("feature").agg(F.count("v").alias("n_distinct"))


# -- sizes and previews ---------------------------------------------------------------


def shape_summary(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows and columns of every table that is present."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols")
            )
            for name, df in tables.items()
            if df is not None
        ]
    )


def schema_summary(tables: dict[str, DataFrame], sample: int = 10) -> DataFrame:
    """Rows, columns and the first column names per table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("dataset"),
                "n_rows",
                F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
                F.array(*map(F.lit, df.columns[:sample])).alias("columns_sample"),
            )
            for name, df in tables.items()
        ]
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


# -- classes --------------------------------------------------------------------------


def class_distribution(y: DataFrame) -> DataFrame:
    """Matches and share per class, largest first."""
    one_row = y.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in CLASS_NAMES])
    total = sum((F.col(c) for c in CLASS_NAMES[1:]), F.col(CLASS_NAMES[0]))
    cells = [
        F.struct(F.lit(c).alias("class_name"), F.col(c).alias("n"), F.try_divide(F.col(c), total).alias("ratio"))
        for c in CLASS_NAMES
    ]
    return one_row.select(F.inline(F.array(*cells))).orderBy(F.desc("n"), "class_name")


def majority_baseline(y: DataFrame) -> DataFrame:
    """Accuracy of always predicting the most frequent class; NULL without labels."""
    return class_distribution(y).agg(F.max("ratio").alias("baseline_accuracy"))


# -- one numeric column ---------------------------------------------------------------


def describe_column(
    df: DataFrame, column: str, probabilities: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9), approximate: bool = False
) -> DataFrame:
    """count, mean, std, min, percentiles and max in one row."""
    names = {p: f"p{round(p * 100)}" for p in probabilities}
    c = quoted(column).cast("double")
    moments = [
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"),
    ]
    if approximate:
        sketches = [F.percentile_approx(c, float(p)).alias(names[p]) for p in probabilities]
        return df.agg(*moments, *sketches).select("n", "mean", "std", "min", *names.values(), "max")
    # several passes follow: they read the one column as written here, not what led to it
    df = cut_lineage(df.select(quoted(column)))
    exact = exact_percentiles(df, column, probabilities)
    return df.agg(*moments).select(
        "n", "mean", "std", "min", *[F.lit(exact[p]).cast("double").alias(names[p]) for p in probabilities], "max"
    )


def histogram(df: DataFrame, column: str, bins: int = 31) -> DataFrame:
    """Rows per equal-width bin, empty bins included; the last bin is closed on the right.

    A constant column gets one unit-wide range around its value.
    """
    c = quoted(column).cast("double")
    known = cut_lineage(df.select(c.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")))
    ends = known.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    if ends["low"] is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_low double, bin_high double, n bigint")
    low, high = ends["low"], ends["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    v = F.col("v")
    edge = lambda i: F.lit(low) + i * F.lit(width)
    guess = F.least(F.floor((v - F.lit(low)) / F.lit(high - low) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    # rounding may put a value one bin off the edges that are reported
    settled = (
        F.when(v < edge(guess), guess - 1)
        .when((v >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    counted = known.select(settled.alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("at"))
    return grid.join(counted, "at", "left").select(
        (F.col("at") + 1).alias("bin"),
        edge(F.col("at")).alias("bin_low"),
        F.when(F.col("at") == bins - 1, F.lit(high)).otherwise(edge(F.col("at") + 1)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


# -- many numeric columns ---------------------------------------------------------------


def variances(df: DataFrame, key: str = "ID") -> DataFrame:
    return column_measures(df, numeric_columns(df, [key]), {"variance": "var_samp({})"})


def variance_extremes(df: DataFrame, key: str = "ID", k: int = 15) -> DataFrame:
    """The k largest and the k smallest variances; an undefined one counts as smallest."""
    # one row per column of the table, so one partition holds them easily
    everything = Window.partitionBy(F.lit(0))
    from_top = F.row_number().over(everything.orderBy(F.desc_nulls_last("variance"), "feature"))
    from_bottom = F.row_number().over(everything.orderBy(F.asc_nulls_first("variance"), F.desc("feature")))
    ranked = variances(df, key).select("feature", "variance", from_top.alias("_top"), from_bottom.alias("_bottom"))
    parts = F.array_compact(F.array(F.when(F.col("_top") <= k, "top"), F.when(F.col("_bottom") <= k, "bottom")))
    return ranked.select("feature", "variance", F.explode(parts).alias("part"))


def target_correlations(df: DataFrame, targets: Sequence[str] = CLASS_NAMES, exclude: Sequence[str] = ("ID", "GOAL_DIFF_HOME_AWAY")) -> DataFrame:
    """``feature, target, abs_corr`` for every numeric feature and every target."""
    features = numeric_columns(df, [*exclude, *targets])
    measures = {f"t{i}": f"abs({pearson('{0}', tick(t))})" for i, t in enumerate(targets)}
    wide = column_measures(df, features, measures, carry=targets, aggregates=9)
    pairs = ", ".join(f"struct({literal(t)} AS target, t{i} AS abs_corr)" for i, t in enumerate(targets))
    return wide.selectExpr("feature", f"inline(array({pairs}))")


def top_target_correlations(df: DataFrame, k: int = 10, **options) -> DataFrame:
    """The k strongest features per target. Ranks one short list of column names per target."""
    order = Window.partitionBy("target").orderBy(F.desc_nulls_last("abs_corr"), "feature")
    return (
        target_correlations(df, **options)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )
