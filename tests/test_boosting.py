import math
import random

import pytest
from pyspark.sql import functions as F

from matchspark.models import rounds, trees
from matchspark.models.artifact import Artifact
from matchspark.models.nested import best_round, cut_boosted, node_table, saved_forest, shrunken
from matchspark.models.trees import TUNED_BOOST, BoostSettings, fit_boosted, shared_rows
from matchspark.operators.evaluate import CLASSES
from matchspark.session import scratch_path

FEATURES = ["a", "b"]
SMALL = BoostSettings(rounds=6, learning_rate=0.3, max_depth=2)


@pytest.fixture(scope="module")
def ready(spark):
    rnd = random.Random(6)
    made = []
    for i in range(240):
        a, b = rnd.random(), rnd.random()
        made.append((i, (int(3 * a) + (rnd.random() < 0.25) * rnd.choice([1, 2])) % 3, a, b, 1.0 + i % 2, i % 3 == 0))
    df = spark.createDataFrame(made, "ID int, label int, a double, b double, weight double, valid boolean")
    return shared_rows(df, FEATURES, ["ID", "weight", "valid"])


def losses(spark, model, rows, k):
    """Mean weighted logistic loss after every round, from the trees' own predictions."""
    values = [0.0] * len(model.trees)
    seen = rows.where("valid").collect()
    for r in seen:
        margin, y = 0.0, 1 if int(r.label) == k else -1
        for t, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
            margin += weight * tree.predict(r.features)
            values[t] += 2 * math.log1p(math.exp(-2 * y * margin)) * r.weight
    return [v / sum(r.weight for r in seen) for v in values]


def test_best_round_waits_for_patience():
    assert best_round([3, 2, 4, 5, 1], 2) == (2, True)
    assert best_round([3, 2, 4, 1, 5], 3) == (4, False)
    assert best_round([1, 1, 1], 2) == (1, True) and best_round([5], 1) == (1, False)


def test_patience_keeps_the_best_round(spark, ready):
    settings = BoostSettings(rounds=24, learning_rate=1.0, max_depth=4, patience=2, row_share=0.7)
    model = fit_boosted(ready, FEATURES, settings, valid="valid")
    for k in CLASSES:
        longest = settings.estimator(f"_is{k}", "weight", None).fit(
            ready.where("NOT valid").withColumn(f"_is{k}", (F.col("label") == k).cast("double"))
        )
        found = losses(spark, longest, ready, k)
        # The longer ensemble begins with the trees of the kept one, and the kept round is the best of those looked at.
        kept = model.per_class[k]
        assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in longest.trees[: kept.getNumTrees]]
        assert kept.getNumTrees == best_round(found, 2)[0] and kept.getNumTrees < 24
        assert found[kept.getNumTrees - 1] == min(found[: kept.getNumTrees + 2])
        assert kept.treeWeights == longest.treeWeights[: kept.getNumTrees]
    with pytest.raises(ValueError):
        fit_boosted(ready, FEATURES, settings)


def test_rounds_are_cut_and_leaves_shrink(spark, ready):
    model = fit_boosted(ready, FEATURES, SMALL).per_class[0]
    path = saved_forest(model, spark)
    whole = cut_boosted(spark, path, scratch_path(spark, "boosted"), 6)
    shorter = fit_boosted(ready, FEATURES, BoostSettings(rounds=3, learning_rate=0.3, max_depth=2)).per_class[0]
    cut = cut_boosted(spark, path, scratch_path(spark, "boosted"), 3)
    some = [r.features for r in ready.limit(50).collect()]
    assert [whole.predictProbability(x) for x in some] == [model.predictProbability(x) for x in some]
    assert [cut.predictProbability(x) for x in some] == [shorter.predictProbability(x) for x in some]
    stats = {(r.treeID, r.nodeData.id): r.nodeData for r in node_table(spark, path).collect()}
    # Without penalties the formula gives the values as grown.
    leaves = {at: n for at, n in stats.items() if n.leftChild < 0}
    assert all(n.prediction == pytest.approx(n.impurityStats[1] / n.impurityStats[0], abs=1e-9) for n in leaves.values())
    shrunk = cut_boosted(spark, path, scratch_path(spark, "boosted"), 6, l1=0.5, l2=5.0)
    after = {(r.treeID, r.nodeData.id): r.nodeData for r in node_table(spark, saved_forest(shrunk, spark)).collect()}
    assert set(after) == set(stats)
    for at, n in stats.items():
        count, total = n.impurityStats[:2]
        want = math.copysign(max(abs(total) - 0.5, 0), total) / (count + 5.0) if at in leaves else n.prediction
        assert after[at].prediction == pytest.approx(want, abs=1e-12)
        assert at not in leaves or abs(after[at].prediction) < abs(n.prediction) or n.prediction == 0


def test_sums_per_leaf_equal_sql(spark, ready):
    """What the node table tells of a first tree's leaves is what a grouping of the rows by their leaf gives."""
    model = fit_boosted(ready, FEATURES, BoostSettings(rounds=1, max_depth=3)).per_class[1]
    scored = model.setLeafCol("leaf").transform(ready)
    from pyspark.ml.functions import vector_to_array

    scored.select("label", "weight", vector_to_array("leaf")[0].cast("int").alias("leaf")).createOrReplaceTempView("leaves")
    # The first tree is fitted to the classes, as -1 and 1.
    sums = spark.sql("SELECT leaf, sum(weight) AS n, sum(CASE WHEN label = 1 THEN weight ELSE -weight END) AS total FROM leaves GROUP BY leaf")
    nodes = node_table(spark, saved_forest(model, spark)).select("nodeData.*").where("leftChild < 0").orderBy("id").collect()
    got = sums.withColumn("value", shrunken(F.col("total"), F.col("n"), 0.5, 2.0)).orderBy("leaf").collect()
    assert [(r.n, r.total) for r in got] == [pytest.approx((n.impurityStats[0], n.impurityStats[1])) for n in nodes]
    assert [r.value for r in got] == [pytest.approx(math.copysign(max(abs(r.total) - 0.5, 0), r.total) / (r.n + 2)) for r in got]


def test_tuned_settings_end_by_patience_and_can_be_saved(spark, ready, tmp_path):
    assert TUNED_BOOST.patience == 100 and (TUNED_BOOST.l1, TUNED_BOOST.l2) == (0.5, 5.0)
    model = fit_boosted(ready, FEATURES, BoostSettings(rounds=8, max_depth=2, patience=2, l1=0.1, l2=1.0), valid="valid")
    Artifact(model).save(spark, str(tmp_path / "m"))
    loaded = Artifact.load(spark, str(tmp_path / "m")).model
    assert loaded.rounds_used() == model.rounds_used() and max(model.rounds_used()) <= 8
    assert loaded.score(ready).exceptAll(model.score(ready)).isEmpty()


@pytest.fixture(scope="module")
def coarse(spark):
    """Few values per feature, so that bins are the same wherever they are made."""
    rnd = random.Random(8)
    made = []
    for i in range(900):
        a, b = rnd.randrange(20), rnd.randrange(12)
        made.append((i, (a // 7 + (rnd.random() < 0.3) * rnd.choice([1, 2])) % 3, float(a), float(b), 1.0 + i % 2, i % 3 == 0))
    df = spark.createDataFrame(made, "ID int, label int, a double, b double, weight double, valid boolean")
    return shared_rows(df, FEATURES, ["ID", "weight", "valid"])


@pytest.mark.parametrize(
    "settings",
    [
        BoostSettings(rounds=9, learning_rate=0.5, max_depth=3, min_leaf=4),
        BoostSettings(rounds=9, learning_rate=0.5, max_depth=3, early_stopping=0.01, l1=0.1, l2=1.0),
        BoostSettings(rounds=40, learning_rate=0.7, max_depth=4, patience=3, min_gain=0.01, l1=0.1, l2=1.0),
        BoostSettings(rounds=3, learning_rate=0.7, max_depth=4, patience=3),
        BoostSettings(rounds=12, learning_rate=0.3, max_depth=4, patience=2, min_gain=0.5),
    ],
)
def test_rounds_grown_side_by_side_equal_spark_ml(spark, coarse, monkeypatch, settings):
    valid = None if settings.patience is None and not settings.l2 else "valid"
    want = fit_boosted(coarse, FEATURES, settings, valid=valid)
    monkeypatch.setattr(trees, "ROWS_BY_CLASS", 100)
    monkeypatch.setattr(rounds, "GENERATIONS_CACHED", 3)
    monkeypatch.setattr(trees.GBTClassifier, "fit", only_templates(trees.GBTClassifier.fit))
    got = fit_boosted(coarse, FEATURES, settings, valid=valid)
    assert got.rounds_used() == want.rounds_used()
    for mine, theirs in zip(got.per_class, want.per_class):
        assert mine.treeWeights == theirs.treeWeights
        assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    shares = [[tuple(r) for r in m.score(coarse).orderBy("ID").select("p_home", "p_draw", "p_away", "prediction").collect()] for m in (got, want)]
    assert all(a == pytest.approx(b, abs=1e-9) for a, b in zip(*shares))


def only_templates(fit):
    """Growing side by side asks Spark ML for no more than one round of a few rows."""

    def checked(estimator, rows, *args):
        assert estimator.getMaxIter() == 1 and rows.count() <= 64
        return fit(estimator, rows, *args)

    return checked


def test_patience_grows_no_round_twice(spark, coarse, monkeypatch):
    """Each round costs a pass per level once, and growing ends with the round that decides."""
    seen, passes = [], rounds._pass
    monkeypatch.setattr(trees, "ROWS_BY_CLASS", 100)
    monkeypatch.setattr(rounds, "_pass", lambda *a: seen.append((a[5], len(a[2]))) or passes(*a))
    settings = BoostSettings(rounds=500, learning_rate=0.5, max_depth=2, patience=4, row_share=0.7, feature_subset="0.6")
    model = fit_boosted(coarse, FEATURES, settings, valid="valid")
    numbers = [number for number, _ in seen]
    assert numbers == sorted(numbers) and max(numbers) == max(model.rounds_used()) + 4
    assert all(numbers.count(n) <= 2 for n in numbers)
    assert fit_boosted(coarse, FEATURES, settings, valid="valid").score(coarse).exceptAll(model.score(coarse)).isEmpty()
