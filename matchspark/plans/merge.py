"""Raw files to merged tables and aligned labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchspark.functions.expressions import CLASS_NAMES
from matchspark.operators.joins import align_to_ids, match_table, missing_rows
from matchspark.sources import files


def read_split(
    spark: SparkSession, inputs: dict[str, str | None], split: str, sample_rows: int | None = None, multiline: bool = False
) -> list[DataFrame | None]:
    """The four raw tables of a split, typed by all rows; ``sample_rows`` chooses player columns by the first rows."""
    home, away = (files.read_csv(spark, inputs[f"{split}_{side}"], multiline=multiline) for side in files.SIDES[:2])
    player_paths = [inputs.get(f"{split}_{side}") for side in files.SIDES[2:]]
    players = [files.read_player_csv(spark, p, rows=sample_rows, multiline=multiline) if p else None for p in player_paths]
    return [home, away, *players]


def merge_matches(
    spark: SparkSession,
    train_dir: str,
    test_dir: str,
    out_dir: str,
    y_path: str | None = None,
    y_supp_path: str | None = None,
    *,
    lenient: bool = False,
    moments: str = "sample",
    fmt: str = "parquet",
    sample_rows: int | None = None,
    multiline: bool = False,
) -> dict[str, str]:
    """Find, roll up, join and write both splits; then align the labels to the train ids.

    Labels are aligned to the written train table, so the merge runs once. ``multiline`` is for raw
    files with line breaks inside quoted fields.
    """
    inputs = files.require_teams(files.discover_inputs(spark, train_dir, test_dir))
    how = "left" if lenient else "inner"
    merged = {
        split: match_table(*read_split(spark, inputs, split, sample_rows, multiline), team_how=how, moments=moments)
        for split in ("train", "test")
    }
    paths = files.write_merged(merged["train"], merged["test"], out_dir, fmt)
    written = files.read_written(spark, paths["train"], merged["train"].schema, fmt)
    for name, columns, y in (
        ("y_train_aligned", CLASS_NAMES, files.read_labels(spark, y_path, multiline)),
        ("y_train_supp_aligned", ("GOAL_DIFF_HOME_AWAY",), files.read_goal_differences(spark, y_supp_path, multiline)),
    ):
        if y is not None:
            paths[name] = files.write_table(align_to_ids(written.select("ID"), y), f"{out_dir}/{name}", fmt)
            aligned = files.read_written(spark, paths[name], y.schema, fmt)
            paths[f"{name}_missing"] = files.write_report(missing_rows(aligned, columns), f"{out_dir}/{name}_missing")
    return paths
