import random
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchspark.models.artifact import Artifact
from matchspark.models.importance import permutation_importance, shuffles
from matchspark.models.search import FOREST_GRID, SCENARIOS, combinations, grid_search
from matchspark.models.trees import HISTOGRAM_BOOST, TUNED_BOOST, BoostSettings, ForestSettings, fit_boosted, fit_forest
from matchspark.operators import profile, weights
from matchspark.operators.evaluate import accuracy
from matchspark.plans.predict import predict, score
from matchspark.plans.train import boosted_run, run_report, training_table, weighting_scenarios
from matchspark.queries import catalog
from matchspark.session import shared_folder

SMALL = ForestSettings(n_trees=8, max_depth=4)


@pytest.fixture(scope="module")
def league(spark):
    """Labels that follow from one feature, a text column, noise, and unlabelled matches."""
    rnd = random.Random(11)
    x, y, supp = [], [], []
    for i in range(400):
        label = rnd.choice([0, 0, 1, 2])
        x.append((i, label * 2.0 + rnd.random(), rnd.random(), rnd.choice("abc"), None if i % 9 else float("nan")))
        if i % 20:
            y.append((i, int(label == 0), int(label == 1), int(label == 2)))
            supp.append((i, (label == 0) * 2.0 - (label == 2) * 3.0))
    return (
        spark.createDataFrame(x, "ID int, strong double, noise double, league string, empty double"),
        spark.createDataFrame(y, "ID int, HOME_WINS int, DRAW int, AWAY_WINS int"),
        spark.createDataFrame(supp, "ID int, GOAL_DIFF_HOME_AWAY double"),
    )


@pytest.fixture(scope="module")
def prepared(league):
    return training_table(*league)


def test_training_table_joins_on_the_key(prepared):
    table, features, levels = prepared
    assert features == ["strong", "noise", "empty", "league_b", "league_c"]
    assert table.count() == 380 and levels.levels == {"league": ("a", "b", "c")}
    assert table.where("empty <> 0").isEmpty()


def test_label_columns_in_x_are_refused(league):
    x, y, _ = league
    with pytest.raises(ValueError):
        training_table(x.join(y, "ID"), y)


def test_forest_beats_the_majority_and_repeats(prepared, league):
    table, features, _ = prepared
    weighted = weights.add_margin_weight(table, "exp", cap=5.0)
    model = fit_forest(weighted, features, SMALL)
    scored = model.score(weighted)
    assert accuracy(scored).first()[0] > 0.95 > profile.majority_baseline(league[1]).first()[0]
    sums = scored.agg(F.max(F.abs(F.col("p_home") + F.col("p_draw") + F.col("p_away") - 1))).first()[0]
    assert sums < 1e-9
    again = fit_forest(weighted, features, SMALL)
    assert again.importances() == model.importances()
    assert max(model.importances(), key=lambda f: f[1])[0] == "strong"
    report = run_report(scored, model, len(features)).first()
    assert report["n_rows"] == 380 and report["top_features"][0]["feature"] == "strong"


def test_two_classes_are_refused(prepared):
    table, features, _ = prepared
    model = fit_forest(table.where("label < 2").withColumn("weight", F.lit(1.0)), features, SMALL)
    with pytest.raises(ValueError):
        model.score(table)


def test_grid_search(prepared):
    table, features, _ = prepared
    weighted = weights.add_margin_weight(table, "none")
    found = grid_search(weighted, features, {"max_depth": (1, 4)}, base=SMALL)
    assert len(found.table) == 2 and found.best.max_depth == 4
    assert found.best_accuracy == max(score for _, score in found.table)
    assert len(combinations(FOREST_GRID)) == 48 and len(SCENARIOS) == 3


def test_scenarios_write_and_promote_the_best(spark, prepared, tmp_path):
    table, features, _ = prepared
    out = str(tmp_path / "runs")
    results, runs = weighting_scenarios(table, features, grid={"max_depth": (3,)}, base=SMALL, out_dir=out)
    assert {r["run_name"] for r in results.collect()} == {"no_weight", "linear_small", "exp_soft"}
    assert results.first()["run_name"] == runs[0].run_name
    assert spark.read.csv(f"{out}/weighting_compare", header=True).count() == 3
    best = Artifact.load(spark, f"{out}/best")
    assert best.model.features == features and best.model.importances() == runs[0].model.importances()
    assert spark.read.json(f"{out}/exp_soft/metrics").count() == 1


def test_boosted_probabilities_and_early_stopping(prepared):
    table, features, _ = prepared
    rows_in = weights.ClassWeights.fit(table).apply(table).withColumn("_valid", F.col("ID") % 4 == 0)
    settings = BoostSettings(rounds=12, max_depth=2, early_stopping=0.5)
    model = fit_boosted(rows_in, features, settings, valid="_valid")
    assert max(model.rounds_used()) < 12
    scored = model.score(table)
    assert scored.columns == [*table.columns, "p_home", "p_draw", "p_away", "prediction"]
    assert scored.where("abs(p_home + p_draw + p_away - 1) > 1e-9").isEmpty()
    assert accuracy(scored).first()[0] > 0.95


def test_boosted_run_and_batch_scoring(spark, league, prepared, tmp_path):
    table, features, levels = prepared
    run = boosted_run(
        table, features, settings=BoostSettings(rounds=4, max_depth=3), tune_draw=True, permute_top=1,
        levels=levels, out_dir=str(tmp_path / "boost"),
    )
    assert "empty" not in run.artifact.model.features
    accuracies = {r["split"]: r for r in run.accuracies.collect()}
    assert set(accuracies) == {"train", "valid", "holdout"} and sum(r["n_rows"] for r in accuracies.values()) == 380
    assert run.permutation.first()["feature"] == "strong" and run.permutation.first()["importance"] > 0.2
    loaded = Artifact.load(spark, str(tmp_path / "boost/model"))
    assert loaded == Artifact(loaded.model, run.artifact.dropped, levels, run.artifact.draw_factor)
    test = league[0].drop("noise").withColumn("extra", F.lit("text"))
    out = str(tmp_path / "submission")
    assert predict(test, loaded, out).count() == 400
    written = spark.read.csv(out, header=True, inferSchema=True)
    assert rows(written.selectExpr("HOME_WINS + DRAW + AWAY_WINS as s").distinct()) == [(1,)]
    assert rows(score(league[0], loaded)) == rows(score(league[0].repartition(7), loaded))
    with pytest.raises(ValueError):
        predict(test.drop("ID"), loaded)


def test_scoring_equals_training_features(spark, league, prepared, tmp_path):
    """A row scored from the raw table gets what it got in training."""
    table, features, levels = prepared
    model = fit_forest(weights.add_margin_weight(table, "none"), features, SMALL)
    Artifact(model, categories=levels).save(spark, str(tmp_path / "m"))
    raw = score(league[0], Artifact.load(spark, str(tmp_path / "m")))
    trained = model.score(table).select("ID", "p_home", "p_draw", "p_away", "prediction")
    assert raw.join(trained.select("ID"), "ID", "left_semi").exceptAll(trained).isEmpty()


def test_shuffle_keeps_the_values(spark):
    df = spark.range(1000).selectExpr("id as ID", "cast(id as double) as v", "id % 3 as _bucket")
    out = shuffles(df, ["v"], "ID", [1, 2])
    assert out.columns == ["ID", "v", "_bucket", "repeat", "shuffled"]
    orders = [{i: v for i, v, _, r, _ in rows(out) if r == repeat} for repeat in (0, 1)]
    for values in orders:
        assert sorted(values.values()) == [float(i) for i in range(1000)]
        assert all(i % 3 == v % 3 and i != v for i, v in values.items())
    assert orders[0] != orders[1]


def test_all_shuffles_share_one_exchange(spark):
    df = spark.range(1000).selectExpr("id as ID", "id % 3 as _bucket", *[f"cast(id * {k} as double) as v{k}" for k in range(5)])
    plan = shuffles(df, [f"v{k}" for k in range(5)], "ID", [1, 2, 3])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_permutation_importance(prepared):
    table, features, _ = prepared
    model = fit_forest(weights.add_margin_weight(table, "none"), features, SMALL)
    out = {r["feature"]: r["importance"] for r in permutation_importance(model, table, ["strong", "empty"], repeats=2).collect()}
    assert out["strong"] > 0.2 and out["empty"] == 0.0


def test_too_deep_trees_are_refused():
    with pytest.raises(ValueError, match="beyond 30"):
        ForestSettings(max_depth=40)


def test_configured_folder_is_used(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_registered_queries_run_the_published_settings(monkeypatch):
    class Stop(Exception):
        pass

    called = {}

    def catch(name):
        def stop(*args, **options):
            called[name] = (args, options)
            raise Stop

        return stop

    monkeypatch.setattr(catalog, "prepared", lambda spark, sf_dir: (None, ["a"], None))
    monkeypatch.setattr(catalog.weights, "add_margin_weight", lambda table, *a, **o: table)
    for name in ("grid_search", "weighting_scenarios", "fit_forest", "boosted_run"):
        monkeypatch.setattr(catalog, name, catch(name))
    for name in ("rf_grid_cv", "weighting_scenarios", "rf_weighted", "gbt_ovr"):
        with pytest.raises(Stop):
            catalog.QUERIES[name](None, "")
    # All settings of the published grid, with a twentieth of the trees.
    assert called["grid_search"][0][2] == called["weighting_scenarios"][1]["grid"] == {**FOREST_GRID, "n_trees": (10, 20)}
    assert len(combinations(called["grid_search"][0][2])) == len(combinations(FOREST_GRID)) == 48
    assert called["grid_search"][1]["base"] == called["weighting_scenarios"][1]["base"] == ForestSettings()
    assert called["fit_forest"][0][2] == catalog.FOREST == ForestSettings()
    assert called["boosted_run"][1]["settings"] == HISTOGRAM_BOOST and "permute_top" not in called["boosted_run"][1]
    with pytest.raises(Stop):
        catalog.QUERIES["gbt_tuned"](None, "")
    assert called["boosted_run"][1]["settings"] == TUNED_BOOST


def test_searches_take_all_published_trees(monkeypatch):
    """Every setting is grown with the published 200 and 400 trees."""
    asked = []
    monkeypatch.setattr(catalog, "prepared", lambda spark, sf_dir: (None, ["a"], None))
    monkeypatch.setattr(catalog.weights, "add_margin_weight", lambda table, *a, **o: table)
    monkeypatch.setattr(catalog, "grid_search", lambda table, features, grid, **o: asked.append(grid) or SimpleNamespace(frame=lambda spark: None))
    catalog.QUERIES["rf_grid_cv"](None, "")
    monkeypatch.setattr(catalog, "weighting_scenarios", lambda table, features, grid, **o: asked.append(grid) or (None, []))
    catalog.QUERIES["weighting_scenarios"](None, "")
    assert asked == [FOREST_GRID, FOREST_GRID] and FOREST_GRID["n_trees"] == (200, 400)


def test_permutation_nobody_reads_costs_nothing(spark, monkeypatch):
    from matchspark.plans import train

    asked = []
    monkeypatch.setattr(train, "permutation_importance", lambda model, valid, features, key: asked.append(features) or valid)
    table = spark.range(60).selectExpr("id AS ID", "CAST(id % 3 AS int) AS label", "CAST(id % 3 AS double) AS a", "CAST(id * 7 % 11 AS double) AS b")
    run = train.boosted_run(table, ["a", "b"], settings=BoostSettings(rounds=1, max_depth=1))
    assert run.accuracies.count() == 3 and not asked
    assert run.permutation is run.permutation and len(asked) == 1 and set(asked[0]) == {"a", "b"}
    assert train.boosted_run(table, ["a", "b"], settings=BoostSettings(rounds=1, max_depth=1), permute_top=0).permutation is None
