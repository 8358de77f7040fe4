import pytest
from conftest import rows

from matchspark.operators import dedup, joins


@pytest.fixture
def repeated(spark):
    return spark.createDataFrame(
        [(1, 5.0, "b"), (1, 5.0, "b"), (1, 3.0, "c"), (2, 1.0, "z"), (None, 9.0, "n")], "ID int, x double, t string"
    )


def test_first_per_key(repeated):
    assert rows(dedup.first_per_key(repeated, order_by=["x"])) == [(1, 3.0, "c"), (2, 1.0, "z")]
    assert rows(dedup.first_per_key(repeated, order_by=["t"])) == [(1, 5.0, "b"), (2, 1.0, "z")]
    assert dedup.first_per_key(repeated, order_by=["t"]).columns == ["ID", "x", "t"]
    with pytest.raises(ValueError):
        dedup.first_per_key(repeated, order_by=["absent"])


def test_key_only_table(spark):
    assert rows(dedup.first_per_key(spark.createDataFrame([(1,), (1,), (None,)], "ID int"))) == [(1,)]


def test_removed_counts(repeated):
    assert tuple(dedup.removed_counts(repeated).first()) == (5, 1, 1, 3)


def test_uniqueness(repeated, spark):
    report = dedup.uniqueness_report({"r": repeated, "u": spark.createDataFrame([(1,), (2,)], "ID int")})
    assert rows(report) == [("r", 5, 2, False), ("u", 2, 2, True)]
    with pytest.raises(ValueError):
        dedup.require_unique(repeated)


def test_one_to_one(repeated, spark):
    unique = spark.createDataFrame([(1, "l"), (3, "m")], "ID int, l string")
    other = spark.createDataFrame([(1, "r")], "ID int, r string")
    assert rows(joins.join_one_to_one(unique, other)) == [(1, "l", "r")]
    with pytest.raises(ValueError):
        joins.join_one_to_one(unique, repeated)


def test_missing_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, 1), (1, 2)], "ID int, a int")
    right = spark.createDataFrame([(None, 3), (1, 4)], "ID int, b int")
    assert rows(joins.join_on_key(left, right)) == [(1, 2, 4)]
    assert rows(joins.join_on_key(left, right, how="left")) == [(None, 1, None), (1, 2, 4)]


def tables(spark):
    home = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "ID int, a int")
    away = spark.createDataFrame([(1, 11), (2, 21)], "ID int, a int")
    players = spark.createDataFrame([(1, 1.0), (1, 3.0), (3, 5.0)], "ID int, p double")
    return home, away, players


def test_merge_modes(spark):
    home, away, players = tables(spark)
    strict = joins.match_table(home, away, players, None)
    assert strict.columns == [
        "ID", "home_teama", "away_teama",
        "home_player_p_sum", "home_player_p_mean", "home_player_p_std", "home_player_player_count",
    ]
    assert [r[0] for r in rows(strict, "ID")] == [1]
    assert [r[0] for r in rows(joins.mixed_match_table(home, away, players), "ID")] == [1, 2]
    assert [r[0] for r in rows(joins.lenient_match_table(home, away, players), "ID")] == [1, 2, 3]
    named = joins.match_table(home, away, prefixes=("home_team_", "away_team_", "hp_", "ap_"))
    assert named.columns == ["ID", "home_team_a", "away_team_a"]


def test_merge_keeps_first_of_repeated_keys(spark):
    home = spark.createDataFrame([(1, 2, "late"), (1, 1, "early")], "ID int, n int, t string")
    away = spark.createDataFrame([(1, 7), (1, 5)], "ID int, m int")
    out = joins.match_table(home, away, tiebreak=(["n"], ["m"]))
    assert rows(out) == [(1, 1, "early", 5)]


def test_player_rows_beside_match(spark):
    home, _, players = tables(spark)
    left_join = home.join(players, "ID", "left")
    assert rows(joins.players_with_match(home, players)) == rows(left_join)
    stacked = joins.stacked_players(home, players, players.limit(0))
    assert stacked.columns == ["ID", "a", "p", "side"]
    assert stacked.where("side = 'home'").count() == 4 and stacked.where("side = 'away'").count() == 3


def test_player_rows_need_one_row_per_match(spark):
    home, _, players = tables(spark)
    with pytest.raises(ValueError):
        joins.stacked_players(home.union(home), players, players)


def test_fan_out_counts_the_pairing(spark):
    home, away, players = tables(spark)
    counted = joins.fan_out(home, players, players)
    paired = home.join(players, "ID", "left").join(players.withColumnRenamed("p", "q"), "ID", "left")
    assert counted.agg({"paired_rows": "sum"}).first()[0] == paired.count()


def test_label_alignment(spark):
    ids = spark.createDataFrame([(3,), (1,)], "ID int")
    y = spark.createDataFrame([(1, 0), (2, 1)], "ID int, DRAW int")
    aligned = joins.align_to_ids(ids, y)
    assert [tuple(r) for r in aligned.collect()] == [(1, 0), (3, None)]
    assert tuple(joins.missing_rows(aligned, ["DRAW"]).first()) == (1, 2)
    assert tuple(joins.missing_rows(aligned.limit(0), ["DRAW"]).first()) == (0, 0)
    assert rows(joins.keep_known_ids(y, ids)) == [(1, 0)]
    assert rows(joins.labelled_features(y, ids.selectExpr("ID", "ID * 2 as f"))) == [(1, 0, 2), (2, 1, None)]
    assert joins.overlap_count(ids, y).first()[0] == 1


def test_first_of_a_hot_key_is_folded_before_the_shuffle(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as ID", "id as n")
    out = dedup.first_per_key(df, order_by=["n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange") and "Window" not in plan
    assert out.count() == 20_001 and out.where("ID = -1").first()["n"] == 0


def test_each_input_of_the_merge_is_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        home, away, players = tables(spark)
        plan = joins.match_table(home, away, players, players)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 4 and plan.count("SortMergeJoin") == 3
