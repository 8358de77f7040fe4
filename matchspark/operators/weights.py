"""Class labels, margins and row weights on joined tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspark.functions.expressions import CLASS_NAMES, class_from_one_hot, margin_weight, win_margin
from matchspark.operators.columns import quoted, require_columns
from matchspark.operators.quantiles import exact_percentiles
from matchspark.session import cut_lineage

MAX_CLASSES = 1000


def class_labels(y: DataFrame, key: str = "ID", unlabelled: str = "null") -> DataFrame:
    """``key, label`` from the one-hot table."""
    require_columns(y, (key, *CLASS_NAMES), "label table")
    return y.select(key, class_from_one_hot(*map(quoted, CLASS_NAMES), unlabelled=unlabelled).alias("label"))


def labelled_only(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(quoted(label).isNotNull())


def match_margins(y: DataFrame, y_supp: DataFrame | None, key: str = "ID") -> DataFrame:
    """``key, margin``; 0 throughout without goal differences."""
    require_columns(y, (key, *CLASS_NAMES), "label table")
    if y_supp is None:
        return y.select(key, F.lit(0.0).alias("margin"))
    require_columns(y_supp, (key, "GOAL_DIFF_HOME_AWAY"), "goal difference table")
    margin = win_margin(F.col("HOME_WINS"), F.col("AWAY_WINS"), F.col("GOAL_DIFF_HOME_AWAY"))
    return y.join(y_supp, key, "left").select(key, margin.alias("margin"))


def add_margin_weight(df: DataFrame, scheme: str, name: str = "weight", margin: str = "margin", **options) -> DataFrame:
    return df.withColumn(name, margin_weight(quoted(margin), scheme, **options))


@dataclass(frozen=True)
class ClassWeights:
    """Weight n / (k * n_c) per class, from the rows it was fitted on."""

    weights: dict

    @staticmethod
    def fit(df: DataFrame, label: str = "label") -> "ClassWeights":
        counts = class_counts(df, label)
        total = sum(counts.values())
        return ClassWeights({c: total / (len(counts) * n) for c, n in counts.items()})

    def expression(self, label: Column) -> Column:
        chosen = F.lit(None).cast("double")
        for value, weight in self.weights.items():
            chosen = F.when(label == F.lit(value), F.lit(weight)).otherwise(chosen)
        return chosen

    def apply(self, df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
        return df.withColumn(name, self.expression(quoted(label)))


def class_counts(df: DataFrame, label: str = "label", max_classes: int = MAX_CLASSES) -> dict:
    """Rows per class; raises for a column with more than ``max_classes`` values: it is no class label."""
    rows = labelled_only(df, label).groupBy(quoted(label)).count().limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} values: not a class label")
    return {row[0]: row[1] for row in sorted(rows, key=lambda r: r[0])}


def weight_summary(df: DataFrame, weight: str = "weight", name: str = "all") -> DataFrame:
    """min, median and max of the weights in one row."""
    df = cut_lineage(df.select(quoted(weight)))
    median = exact_percentiles(df, weight, [0.5])[0.5]
    return df.agg(F.min(quoted(weight)).alias("min_weight"), F.max(quoted(weight)).alias("max_weight")).select(
        F.lit(name).alias("run_name"), "min_weight", F.lit(median).cast("double").alias("median_weight"), "max_weight"
    )
