import pytest
from conftest import rows

from matchspark.operators import evaluate
from matchspark.operators.submission import argmax_class, check_class_order, submission


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(
        [(1, 0, 0.4, 0.35, 0.25), (2, 1, 0.4, 0.38, 0.22), (3, 2, 0.2, 0.2, 0.6), (4, 2, 0.45, 0.1, 0.45)],
        "ID int, label int, p_home double, p_draw double, p_away double",
    )


def test_draw_factor(scored):
    out = evaluate.apply_draw_factor(scored, 1.2).where("ID = 1").first()
    assert [out[c] for c in evaluate.PROBABILITIES] == pytest.approx([0.4 / 1.07, 0.42 / 1.07, 0.25 / 1.07])
    assert rows(evaluate.apply_draw_factor(scored, 1.0)) == rows(scored)


def test_first_best_factor_wins(scored):
    best = evaluate.best_draw_factor(scored).first()
    # 1.1 turns row 2 into a draw, 1.15 also turns row 1
    assert tuple(best) == (1.1, 0.75)


def test_no_rows_leave_the_draw_factor_alone(scored):
    assert tuple(evaluate.best_draw_factor(scored.limit(0)).first()) == (1.0, None)


def test_submissions_sum_to_one(scored):
    hard = submission(scored)
    assert hard.dtypes[1:] == [(c, "tinyint") for c in ("HOME_WINS", "DRAW", "AWAY_WINS")]
    assert rows(hard) == [(1, 1, 0, 0), (2, 1, 0, 0), (3, 0, 0, 1), (4, 1, 0, 0)]
    soft = submission(scored, as_probabilities=True, order=("draw", " away_wins", "HOME_WINS"), names=("HOME", "DRAW", "AWAY"))
    assert soft.columns == ["ID", "DRAW", "AWAY", "HOME"]
    assert all(sum(r[1:]) == pytest.approx(1.0) for r in rows(soft))
    shown = submission(scored, template=["DRAW", "ID", "AWAY_WINS", "HOME_WINS"])
    assert shown.columns == ["DRAW", "ID", "AWAY_WINS", "HOME_WINS"]
    with pytest.raises(ValueError):
        check_class_order(["HOME", "DRAW", "AWAY"])


def test_report_with_a_class_never_predicted(scored):
    predicted = argmax_class(scored)
    confusion = evaluate.confusion_matrix(predicted)
    assert rows(confusion) == [(0, 1, 0, 0), (1, 1, 0, 0), (2, 1, 0, 1)]
    report = {r["class_name"]: r for r in evaluate.classification_report(confusion).collect()}
    assert tuple(report["DRAW"])[1:] == (0.0, 0.0, 0.0, 1)
    assert report["accuracy"]["f1"] == evaluate.accuracy(predicted).first()[0] == 0.5
    assert report["macro avg"]["recall"] == pytest.approx((1 + 0 + 0.5) / 3)
    assert report["weighted avg"]["support"] == 4


def test_report_reproduces_published_numbers(spark):
    """A published confusion matrix and the scores published with it."""
    cells = [[906, 7, 159], [448, 6, 183], [439, 6, 307]]
    confusion = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(cells)], "label int, predicted_0 bigint, predicted_1 bigint, predicted_2 bigint"
    )
    report = {r["class_name"]: r for r in evaluate.classification_report(confusion).collect()}
    assert report["accuracy"]["f1"] == pytest.approx(0.4953271028037383, abs=1e-15)
    assert round(report["macro avg"]["f1"], 4) == 0.3630
    assert round(report["weighted avg"]["f1"], 4) == 0.4141
    assert round(report["DRAW"]["recall"], 4) == 0.0094


def test_rankings(spark):
    results = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.4)], "run_name string, val_accuracy double")
    assert [r["run_name"] for r in evaluate.rank_scenarios(results).collect()] == ["a", "b", "c"]
    assert evaluate.best_scenario(results).first()["run_name"] == "a"
    importances = spark.createDataFrame([("x", 0.1), ("y", 0.9)], "feature string, importance double")
    assert evaluate.top_features(importances, 1).first()["feature"] == "y"
