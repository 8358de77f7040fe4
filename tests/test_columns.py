import pytest
from conftest import rows

from matchspark.operators import columns as cols
from matchspark.operators.encode import _sketch_bound, fit_categories
from matchspark.operators.profile import column_measures, missing_ratio
from matchspark.operators.rollup import roll_up


def frame(spark, names, values):
    return spark.createDataFrame([values], names)


def test_prefix_and_key_order(spark):
    df = frame(spark, ["x", "ID", "y"], (1, 2, 3))
    assert cols.key_first(cols.add_prefix(df, "home_team")).columns == ["ID", "home_teamx", "home_teamy"]


def test_numeric_only_keeps_a_wide_key_exact(spark):
    df = spark.createDataFrame([(2**40 + 1, 1.5, "t", True)], "ID bigint, x double, t string, b boolean")
    out = cols.numeric_only(df, as_float=True)
    assert out.dtypes == [("ID", "bigint"), ("x", "float")]
    assert out.first()["ID"] == 2**40 + 1


def test_drop_text_is_decided_on_train(spark):
    train = spark.createDataFrame([("k", "t", 1)], "ID string, a string, b int")
    test = spark.createDataFrame([("k", 5, "u")], "ID string, a int, b string")
    kept = cols.drop_text(train, test)
    assert [df.columns for df in kept] == [["ID", "b"], ["ID", "b"]]


def test_id_like_names_are_case_sensitive(spark):
    names = ["ID", "TEAM_GAME_WON", "PLAYER_ID", "5_last_match", "LEAGUE_ID", "SHOTS"]
    df = frame(spark, names, tuple(range(6)))
    assert cols.drop_id_like(df).columns == ["ID", "5_last_match", "SHOTS"]
    assert cols.drop_id_like(df, drop=False).columns == names


def test_alignment(spark):
    train = frame(spark, ["z", "id", "a", "only"], (1, 2, 3, 4))
    test = frame(spark, ["a", "z", "id", "extra"], (1, 2, 3, 4))
    left, right = cols.common_columns(train, test, "id")
    assert left.columns == right.columns == ["id", "a", "z"]
    matched = cols.match_features(test, ["z", "absent", "a"], "id")
    assert matched.columns == ["id", "z", "absent", "a"] and rows(matched) == [(3, 2, 0.0, 1)]


def test_template_needs_all_columns(spark):
    df = frame(spark, ["ID", "HOME_WINS", "DRAW", "AWAY_WINS"], (1, 1, 0, 0))
    order = ["AWAY_WINS", "ID", "DRAW", "HOME_WINS", "other"]
    assert cols.reorder_like(df, order).columns == order[:-1]
    assert cols.reorder_like(df, ["ID", "DRAW"]).columns == df.columns


def test_find_key(spark):
    a = frame(spark, ["GAME_ID", "TEAM_ID", "x"], (1, 2, 3))
    b = frame(spark, ["x", "TEAM_ID", "GAME_ID"], (1, 2, 3))
    assert cols.find_key(a, None, b) == "GAME_ID"
    with pytest.raises(ValueError):
        cols.find_key(a, frame(spark, ["q"], (1,)))


def test_canonical_labels(spark):
    df = frame(spark, ["MATCH_ID", "Home_Wins", "home_prob", "Draw", "AWAY"], (7, 1, 0.5, 0, 0))
    assert rows(cols.canonical_labels(df)) == [(7, 1, 0, 0)]
    assert cols.rename_key(frame(spark, ["first", "b"], (1, 2))).columns == ["id", "b"]
    with pytest.raises(ValueError):
        cols.label_roles(["home", "draw"])


def test_label_columns_must_not_leak(spark):
    with pytest.raises(ValueError):
        cols.forbid_columns(frame(spark, ["ID", "DRAW"], (1, 0)))
    with pytest.raises(ValueError):
        cols.require_columns(frame(spark, ["ID"], (1,)), ["ID", "x"])


def test_coercion_never_raises(spark):
    df = spark.createDataFrame(
        [("k1", " 12 ", True), ("k2", "abc", False), ("k3", "1d", None), ("k4", "0x1p3", True), ("k5", ".5e1", None)],
        "ID string, t string, b boolean",
    )
    assert rows(cols.coerce_numeric(df)) == [
        ("k1", 12.0, 1.0), ("k2", None, 0.0), ("k3", None, None), ("k4", None, 1.0), ("k5", 5.0, None),
    ]


def test_odd_numbers_become_zero(spark):
    df = spark.createDataFrame(
        [(1, float("inf")), (2, float("-inf")), (3, float("nan")), (4, None), (5, 1e300), (6, 2.5)], "ID int, x double"
    )
    out = cols.clean_features(df)
    assert out.dtypes == [("ID", "int"), ("x", "float")]
    assert [x for _, x in rows(out)] == [0.0, 0.0, 0.0, 0.0, 0.0, 2.5]
    kept = cols.clean_features(df, as_float=False, fill=None)
    assert [r[1] for r in sorted(kept.collect())] == [None, None, None, None, 1e300, 2.5]


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1, "3")], ["ID", "a.b"])
    assert rows(cols.clean_features(df)) == [(1, 3.0)]


def test_categories(spark):
    train = spark.createDataFrame(
        [(1, "x", True, "only"), (2, "y", False, "only"), (3, None, None, "only")], "ID int, c string, b boolean, s string"
    )
    levels = fit_categories(train)
    out = levels.apply(train)
    assert out.columns == ["ID", "b", "c_y"]
    assert rows(out) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    test = spark.createDataFrame([(4, "y", True, "new"), (5, "unseen", False, "only")], train.schema)
    assert rows(levels.apply(test)) == [(4, 1, 1), (5, 0, 0)]
    assert rows(levels.apply(test.drop("c"))) == [(4, 1, 0), (5, 0, 0)]


@pytest.mark.parametrize("n", [49, 50, 51, 52, 60, 500])
def test_cardinality_limit_is_exact(spark, n):
    df = spark.range(n * 3).selectExpr("id as ID", f"concat('v', id % {n}) as c")
    levels = fit_categories(df)
    assert (len(levels.levels.get("c", ())) == n) == (n <= 50)
    assert levels.dropped == (() if n <= 50 else ("c",))


def test_large_limits_do_without_the_sketch(spark):
    assert _sketch_bound(10_000) == float("inf")
    df = spark.range(900).selectExpr("id as ID", "concat('v', id % 300) as c")
    assert len(fit_categories(df, max_cardinality=300).levels["c"]) == 300
    assert fit_categories(df, max_cardinality=299).dropped == ("c",)


def test_odd_names_and_levels(spark):
    odd = "a{b}.c'd`e \\"
    df = spark.createDataFrame([(1, 2.0, "x"), (2, 3.0, "O'Neil\\n"), (3, None, "x")], ["ID", odd, "t"])
    assert rows(cols.clean_features(cols.numeric_only(cols.add_prefix(df, "p_")))) == [(1, 2.0), (2, 3.0), (3, 0.0)]
    assert fit_categories(df).apply(df).columns == ["ID", odd, "t_x"]
    levels = fit_categories(df.where("t <> 'x'").union(df.selectExpr("*").limit(0)).union(df))
    assert levels.levels["t"] == ("O'Neil\\n", "x")
    assert rows(roll_up(df)) == [(1, 2.0, 2.0, None, 1), (2, 3.0, 3.0, None, 1), (3, 0.0, None, None, 1)]
    assert rows(missing_ratio(df), "feature") == [(odd,), ("t",)]
    wide = column_measures(df, [odd, "ID"], {"n": "count({})"}, aggregates=1)
    assert rows(wide) == [("ID", 3), (odd, 2)]
    swapped = spark.createDataFrame([(1, "b'c"), (2, "a")], "ID int, t string")
    assert rows(fit_categories(swapped).apply(swapped)) == [(1, 1), (2, 0)]


def test_levels_meet_numbers_and_truth_values(spark):
    train = spark.createDataFrame([(1, "A1", "2", "true"), (2, "2", "7.5", "false"), (3, "A1", "7.5", "maybe")], "ID int, a string, b string, c string")
    fitted = fit_categories(train)
    test = spark.createDataFrame([(9, 2, 7.5, True), (8, 7, 2.0, False), (7, None, None, None)], "ID int, a bigint, b double, c boolean")
    out = fitted.apply(test)
    assert out.columns == ["ID", "a_A1", "b_7.5", "c_maybe", "c_true"]
    assert rows(out) == [(7, 0, 0, 0, 0), (8, 0, 0, 0, 0), (9, 0, 1, 0, 1)]
