import math

import pytest
from conftest import rows

from matchspark.operators.rollup import roll_up, roll_up_mean_first


@pytest.fixture
def players(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a"), (1, None, "b"), (2, 5.0, "c"), (3, None, "d"), (None, 7.0, "e")], "ID bigint, x double, name string"
    )


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
def test_sample_moments(players, strategy):
    out = roll_up(players, strategy=strategy)
    assert out.columns == ["ID", "x_sum", "x_mean", "x_std", "player_count"]
    assert rows(out) == [(1, 1.0, 1.0, None, 2), (2, 5.0, 5.0, None, 1), (3, 0.0, None, None, 1)]


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
def test_population_moments_count_every_row(players, strategy):
    out = roll_up(players, moments="population_rows", strategy=strategy)
    assert rows(out) == [(1, 1.0, 0.5, 0.5, 2), (2, 5.0, 5.0, 0.0, 1), (3, 0.0, 0.0, 0.0, 1)]


def test_mean_first_variant(players):
    out = roll_up_mean_first(players, prefix="home_player_")
    assert out.columns == ["ID", "home_player_x_mean", "home_player_x_sum", "home_player_x_std"]


def test_numeric_key_is_no_measure_and_text_keys_work(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "ID string, x double")
    assert rows(roll_up(df)) == [("a", 4.0, 2.0, math.sqrt(2.0), 2)]


def test_chunked_equals_direct_on_many_columns(spark):
    n = 37
    data = [(i % 5, *[None if (i + c) % 4 == 0 else float(i * c % 11) for c in range(n)]) for i in range(60)]
    df = spark.createDataFrame(data, "ID int, " + ", ".join(f"c{c} double" for c in range(n)))
    for moments in ("sample", "population_rows"):
        direct = roll_up(df, moments=moments, strategy="direct")
        chunked = roll_up(df, moments=moments, strategy="chunked", chunk_size=8)
        assert direct.columns == chunked.columns
        for a, b in zip(rows(direct), rows(chunked)):
            assert a == pytest.approx(b, nan_ok=True) if None not in a else a == b


def test_only_text_columns_gives_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "ID int, name string")
    assert rows(roll_up(df)) == [(1, 2)]


def test_unknown_options_raise(players):
    with pytest.raises(ValueError):
        roll_up(players, moments="other")
    with pytest.raises(ValueError):
        roll_up(players, strategy="other")


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
def test_a_hot_key_is_folded_before_the_shuffle(spark, strategy):
    # one key holds a third of the rows
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as ID", "cast(id as double) as x", "cast(1 as double) as y")
    out = roll_up(df, strategy=strategy)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange")
    hot = out.where("ID = -1").first()
    assert hot["player_count"] == 10_000 and hot["x_sum"] == sum(range(0, 30_000, 3))
