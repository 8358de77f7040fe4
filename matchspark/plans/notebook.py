"""The exploratory merge: any key name, teams joined 1:1, players rolled up mean first, numbers only."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchspark.operators import columns as cols
from matchspark.operators.joins import join_one_to_one, keep_known_ids
from matchspark.operators.profile import drop_constant
from matchspark.operators.rollup import roll_up_mean_first
from matchspark.session import cut_lineage, fine_partitions


def merge_teams(home: DataFrame, away: DataFrame, key: str = "ID") -> DataFrame:
    """Both team tables under their prefixes, one row per match; raises if a key repeats."""
    return join_one_to_one(cols.add_prefix(home, "home_team_", [key]), cols.add_prefix(away, "away_team_", [key]), key)


def exploratory_split(
    home: DataFrame, away: DataFrame, home_player: DataFrame | None, away_player: DataFrame | None, key: str = "ID"
) -> DataFrame:
    """The wide table of one split: teams, then the players of each side rolled up per match."""
    table = merge_teams(home, away, key)
    for players, prefix in ((home_player, "home_player_"), (away_player, "away_player_")):
        if players is not None:
            table = table.join(roll_up_mean_first(players, key, prefix=prefix), key, "left")
    return table


def exploratory_merge(
    train: list[DataFrame | None], test: list[DataFrame | None], y: DataFrame, key: str | None = None
) -> dict[str, DataFrame]:
    """``train``, ``test`` and ``labels`` from the four raw tables of each split and the one-hot labels.

    The key is the name that both home tables share and that fits best. Columns constant in train go from both splits,
    then text columns; what is left are the columns both have. Labels get the short names and are cut to the train ids.
    Each split is joined once, by itself, and written.
    """
    key = key or cols.find_key(train[0], test[0])
    with fine_partitions(train[0].sparkSession):
        wide = [cut_lineage(exploratory_split(*tables, key=key)) for tables in (train, test)]
    wide = drop_constant(*wide, key=key)
    shared = cols.common_columns(*[cols.numeric_only(df, key) for df in wide], key)
    labels = y if key in y.columns else y.withColumnRenamed("ID", key)
    known = keep_known_ids(labels, shared[0].select(key), key)
    return {"train": shared[0], "test": shared[1], "labels": cols.canonical_labels(known.withColumnRenamed(key, "id"))}
