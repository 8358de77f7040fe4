"""All profiling reports of a pair of merged tables, written as small files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchspark.functions.expressions import CLASS_NAMES
from matchspark.operators import profile
from matchspark.operators.dedup import uniqueness_report
from matchspark.operators.joins import analysis_table, missing_rows, overlap_count
from matchspark.sources.files import write_report


def profile_matches(
    train: DataFrame,
    test: DataFrame | None = None,
    y: DataFrame | None = None,
    y_supp: DataFrame | None = None,
    *,
    key: str = "ID",
) -> dict[str, DataFrame]:
    """Every report the given tables allow. Pass written tables: each report scans its own columns."""
    tables = {"train_merged": train, "test_merged": test, "y_train_aligned": y, "y_train_supp_aligned": y_supp}
    merged = {name: df for name, df in list(tables.items())[:2] if df is not None}
    out = {
        "shapes": profile.shape_summary(tables),
        "uniqueness": uniqueness_report(merged, key),
        "types": profile.feature_type_counts(merged, key),
        "variances": profile.variance_extremes(train, key),
    }
    for name, df in merged.items():
        out[f"{name}_missing"] = profile.top_missing(df, key)
        out[f"{name}_with_missing"] = profile.columns_with_missing(df, key)
    if test is not None:
        out["overlap"] = overlap_count(train, test, key)
    if y is not None:
        xy = analysis_table(train, y, y_supp, key)
        out["classes"] = profile.class_distribution(y)
        out["baseline"] = profile.majority_baseline(y)
        out["missing_labels"] = missing_rows(xy, CLASS_NAMES, "missing_labels")
        out["correlations"] = profile.top_target_correlations(xy, exclude=(key, "GOAL_DIFF_HOME_AWAY"))
        if y_supp is not None:
            out["missing_goal_differences"] = missing_rows(xy, ["GOAL_DIFF_HOME_AWAY"], "missing_goal_differences")
    if y_supp is not None:
        out["goal_difference"] = profile.describe_column(y_supp, "GOAL_DIFF_HOME_AWAY")
        out["goal_difference_histogram"] = profile.histogram(y_supp, "GOAL_DIFF_HOME_AWAY")
    return out


def write_profile(reports: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    return {name: write_report(df, f"{out_dir}/{name}") for name, df in reports.items()}
