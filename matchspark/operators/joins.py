"""Joins on the match key. Every input is hash-partitioned on the key once and stays so."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.functions.expressions import any_null
from matchspark.operators.columns import add_prefix, key_first, quoted
from matchspark.operators.dedup import first_per_key, key_counts, require_unique
from matchspark.operators.rollup import roll_up


def join_on_key(left: DataFrame, right: DataFrame, key: str = "ID", how: str = "inner") -> DataFrame:
    """Equi-join on the key; a missing key matches nothing."""
    return left.join(right.where(quoted(key).isNotNull()), key, how)


def join_one_to_one(left: DataFrame, right: DataFrame, key: str = "ID", how: str = "inner") -> DataFrame:
    """Join that raises unless the key is unique on both sides."""
    require_unique(left, key, "left side")
    require_unique(right, key, "right side")
    return join_on_key(left, right, key, how)


def match_table(
    home_team: DataFrame,
    away_team: DataFrame,
    home_player: DataFrame | None = None,
    away_player: DataFrame | None = None,
    *,
    key: str = "ID",
    team_how: str = "inner",
    player_how: str | None = None,
    prefixes: tuple[str, str, str, str] = ("home_team", "away_team", "home_player_", "away_player_"),
    tiebreak: tuple[Sequence[str], Sequence[str]] = ((), ()),
    moments: str = "sample",
    strategy: str = "auto",
) -> DataFrame:
    """One row per match: both teams and both player roll-ups side by side.

    Each side is folded to one row per key before the join, so the joins are 1:1 and a repeated
    key never multiplies. Keeping the first home row and the first away row is the same as
    keeping the first row of their product ordered by (home tiebreak, away tiebreak).
    Absent player tables are skipped. ``player_how`` defaults to ``team_how``.
    """
    home = first_per_key(add_prefix(home_team, prefixes[0], (key,)), key, [prefixes[0] + c for c in tiebreak[0]])
    away = first_per_key(add_prefix(away_team, prefixes[1], (key,)), key, [prefixes[1] + c for c in tiebreak[1]])
    table = join_on_key(home, away, key, team_how)
    for players, prefix in ((home_player, prefixes[2]), (away_player, prefixes[3])):
        if players is not None:
            rolled = roll_up(players, key, prefix=prefix, moments=moments, strategy=strategy)
            table = join_on_key(table, rolled, key, player_how or team_how)
    return key_first(table, key)


def lenient_match_table(*tables: DataFrame | None, **options) -> DataFrame:
    """Left joins throughout: every home team row stays."""
    return match_table(*tables, team_how="left", **options)


def mixed_match_table(*tables: DataFrame | None, **options) -> DataFrame:
    """Teams must both be known, players may be absent."""
    return match_table(*tables, team_how="inner", player_how="left", **options)


# -- raw players beside their match ---------------------------------------------------


def players_with_match(teams: DataFrame, players: DataFrame, key: str = "ID") -> DataFrame:
    """LEFT JOIN of raw player rows to the one-row-per-match table, split in two.

    The matched part is an inner join, where adaptive execution may split the side that holds a
    hot key; in a left outer join it may not split the right side. The unmatched part is an anti
    join against the distinct player keys.
    """
    players = players.where(quoted(key).isNotNull())
    matched = teams.join(players, key, "inner")
    lonely = teams.join(players.select(key).distinct(), key, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def stacked_players(teams: DataFrame, home_player: DataFrame, away_player: DataFrame, key: str = "ID") -> DataFrame:
    """Raw player rows of both sides beside their match, stacked under a ``side`` column.

    Pairing every home player with every away player of a match would square a hot match; the
    two sides hold the same information without it. ``fan_out`` counts what the pairing gives.
    Raises if a match has more than one row in ``teams``.
    """
    require_unique(teams, key, "match table")
    sides = [
        players_with_match(teams, players, key).withColumn("side", F.lit(side))
        for side, players in (("home", home_player), ("away", away_player))
    ]
    return key_first(sides[0].unionByName(sides[1], allowMissingColumns=True), key)


def fan_out(teams: DataFrame, home_player: DataFrame, away_player: DataFrame, key: str = "ID") -> DataFrame:
    """Players per side of every match and the rows their left-join pairing would have."""
    home = key_counts(home_player, key).withColumnRenamed("n", "home_rows")
    away = key_counts(away_player, key).withColumnRenamed("n", "away_rows")
    counted = teams.select(key).join(home, key, "left").join(away, key, "left").na.fill(0, ["home_rows", "away_rows"])
    return counted.withColumn(
        "paired_rows", F.greatest("home_rows", F.lit(1)) * F.greatest("away_rows", F.lit(1))
    )


# -- labels beside features -----------------------------------------------------------


def align_to_ids(ids: DataFrame, y: DataFrame, key: str = "ID") -> DataFrame:
    """The labels of exactly these ids, in key order; unlabelled ids stay with NULL."""
    return ids.select(key).join(y.where(quoted(key).isNotNull()), key, "left").orderBy(key)


def keep_known_ids(y: DataFrame, x: DataFrame, key: str = "ID") -> DataFrame:
    return y.join(x.select(key), key, "left_semi")


def labelled_features(y: DataFrame, x: DataFrame, key: str = "ID") -> DataFrame:
    """Every label row with its features; a label without features keeps NULLs."""
    return y.join(x, key, "left")


def analysis_table(x: DataFrame, y: DataFrame, y_supp: DataFrame | None = None, key: str = "ID") -> DataFrame:
    joined = x.join(y, key, "left")
    return joined if y_supp is None else joined.join(y_supp, key, "left")


def missing_rows(df: DataFrame, columns: Sequence[str], name: str = "missing") -> DataFrame:
    """One row: rows with a NULL in any of ``columns``, and all rows."""
    return df.agg(
        F.count_if(any_null(*[quoted(c) for c in columns])).alias(name), F.count(F.lit(1)).alias("n_rows")
    )


def shared_ids(train: DataFrame, test: DataFrame, key: str = "ID") -> DataFrame:
    return train.select(key).where(quoted(key).isNotNull()).intersect(test.select(key))


def overlap_count(train: DataFrame, test: DataFrame, key: str = "ID") -> DataFrame:
    return shared_ids(train, test, key).agg(F.count(F.lit(1)).alias("shared_ids"))
