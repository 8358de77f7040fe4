from collections import Counter
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchspark.functions.expressions import class_from_one_hot, margin_weight
from matchspark.operators import weights
from matchspark.operators.split import HOLDOUT_10_VALID_20, VALID_20, StratifiedSplit, draw, stratified_folds


def one_hot_frame(spark):
    return spark.createDataFrame(
        [(1, 1, 0, 0), (2, 0, 1, 1), (3, None, None, None), (4, 0, 0, 1), (5, 1, None, 0)],
        "ID int, HOME_WINS int, DRAW int, AWAY_WINS int",
    )


def test_class_of_one_hot(spark):
    y = one_hot_frame(spark)
    assert rows(weights.class_labels(y)) == [(1, 0), (2, 1), (3, None), (4, 2), (5, None)]
    assert rows(weights.class_labels(y, unlabelled="home")) == [(1, 0), (2, 1), (3, 0), (4, 2), (5, 1)]
    assert rows(weights.labelled_only(weights.class_labels(y)), "ID") == [(1,), (2,), (4,)]
    with pytest.raises(ValueError):
        class_from_one_hot(F.lit(1), F.lit(0), F.lit(0), unlabelled="other")


def test_win_margin(spark):
    y = spark.createDataFrame(
        [(1, 1, 0, 0), (2, 1, 0, 0), (3, 0, 0, 1), (4, 0, 1, 0), (5, 1, 0, 0), (6, 0, 0, 1)],
        "ID int, HOME_WINS int, DRAW int, AWAY_WINS int",
    )
    supp = spark.createDataFrame(
        [(1, 2.0), (2, -1.0), (3, -3.0), (4, 0.0), (5, None)], "ID int, GOAL_DIFF_HOME_AWAY double"
    )
    assert rows(weights.match_margins(y, supp)) == [(1, 2.0), (2, 0.0), (3, 3.0), (4, 0.0), (5, 0.0), (6, 0.0)]
    assert {m for _, m in rows(weights.match_margins(y, None))} == {0.0}
    with pytest.raises(ValueError):
        weights.match_margins(y, supp.drop("GOAL_DIFF_HOME_AWAY"))


def test_margin_weights(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (3.0,), (20.0,)], "margin double")
    get = lambda *a, **k: [r[0] for r in df.select(margin_weight(F.col("margin"), *a, **k)).collect()]
    assert get("none") == [1.0] * 4
    assert get("linear") == [1.0, 1.25, 1.75, 6.0]
    assert get("exp", beta=9.0, cap=5.0) == pytest.approx([1.0, 1.2214027581601699, 1.8221188003905089, 5.0])
    with pytest.raises(ValueError):
        get("square")
    summary = weights.weight_summary(weights.add_margin_weight(df, "linear"))
    assert tuple(summary.first()) == ("all", 1.0, 1.5, 6.0)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (5, None)], "ID int, label int")
    out = dict(rows(weights.ClassWeights.fit(df).apply(df).select("ID", "weight")))
    assert out == pytest.approx({1: 4 / 6, 2: 4 / 6, 3: 4 / 6, 4: 2.0, 5: None})


def test_too_many_classes_raise(spark):
    with pytest.raises(ValueError):
        weights.class_counts(spark.range(1500).withColumnRenamed("id", "label"))


@pytest.mark.parametrize("digits", [1, 4])
def test_split_equals_ranking_by_draw(spark, digits):
    df = spark.range(997).selectExpr("id as ID", "cast(id % 7 % 3 as int) as label")
    drawn = df.select("ID", "label", draw(F.col("ID"), 42).alias("d")).collect()
    expected = {}
    for label in range(3):
        group = sorted((r for r in drawn if r["label"] == label), key=lambda r: r["d"])
        for rank, r in enumerate(group, 1):
            n = len(group)
            expected[r["ID"]] = "holdout" if rank * 10 <= n else "valid" if rank * 10 <= 3 * n else "train"
    split = StratifiedSplit.fit(df, HOLDOUT_10_VALID_20, digits=digits)
    assert dict(rows(split.apply(df).select("ID", "split"))) == expected


def test_split_parts_are_disjoint_and_whole(spark):
    df = spark.range(500).selectExpr("id as ID", "cast(id % 3 as int) as label")
    split = StratifiedSplit.fit(df, VALID_20)
    parts = [{r[0] for r in split.select(df, p).select("ID").collect()} for p in split.parts]
    assert not parts[0] & parts[1] and len(parts[0] | parts[1]) == 500
    assert [len(p) for p in parts] == [33 + 33 + 33, 401]


def test_split_of_tiny_classes_and_unlabelled_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "ID int, label int")
    out = dict(rows(StratifiedSplit.fit(df, HOLDOUT_10_VALID_20).apply(df).select("ID", "split")))
    assert out == {1: "train", 2: "train", 3: "train", 4: None}


def test_split_keeps_copies_of_a_key_together(spark):
    # one key holds a third of all rows
    df = spark.range(900).selectExpr("if(id < 300, -1, id) as ID", "0 as label")
    split = StratifiedSplit.fit(df, [("a", Fraction(1, 2)), ("b", None)])
    by_key = split.apply(df).groupBy("ID").agg(F.count_distinct("split").alias("n"), F.count("split").alias("c"))
    assert by_key.where("n <> 1").isEmpty() and by_key.agg(F.sum("c")).first()[0] == 900


def test_folds_are_even(spark):
    df = spark.range(300).selectExpr("id as ID", "cast(id % 3 as int) as label")
    folds = stratified_folds(df, 3).apply(df, "fold")
    assert Counter(tuple(r) for r in folds.select("label", "fold").collect()) == {
        (label, str(k)): n for label in range(3) for k, n in enumerate((33, 33, 34))
    }


def test_split_is_a_projection(spark):
    df = spark.range(300).selectExpr("id as ID", "cast(id % 3 as int) as label")
    plan = StratifiedSplit.fit(df, VALID_20).apply(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
