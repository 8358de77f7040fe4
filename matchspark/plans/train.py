"""Training runs: weighted forests compared by scenario, and boosted trees."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.models.artifact import Artifact
from matchspark.models.importance import permutation_importance
from matchspark.models.search import FOREST_GRID, SCENARIOS, SharedBins, grid_search
from matchspark.models.trees import HISTOGRAM_BOOST, BoostSettings, Boosted, Forest, ForestSettings, fit_boosted, importance_table, shared_rows
from matchspark.operators import columns as cols
from matchspark.operators.encode import CategoryLevels, fit_categories
from matchspark.operators.evaluate import (
    PROBABILITIES,
    accuracy,
    accuracy_by_split,
    apply_draw_factor,
    best_draw_factor,
    best_scenario,
    classification_report,
    confusion_matrix,
    rank_scenarios,
    top_features,
)
from matchspark.operators.select import FeatureSelection
from matchspark.operators.split import HOLDOUT_10_VALID_20, VALID_20, StratifiedSplit, stratified_folds
from matchspark.operators.submission import argmax_class
from matchspark.operators.weights import ClassWeights, add_margin_weight, class_labels, labelled_only, match_margins
from matchspark.session import cut_lineage
from matchspark.sources.files import write_report


FOLD = "_fold"


def training_table(
    x: DataFrame, y: DataFrame, y_supp: DataFrame | None = None, *, key: str = "ID", max_cardinality: int = 50,
    drop_id_like: bool = False,
) -> tuple[DataFrame, list[str], CategoryLevels]:
    """Key, label, margin and cleaned float features, joined on the key and written once.

    Unlabelled matches are left out. Returns the table, the features in order and the levels.
    """
    cols.forbid_columns(x)
    kept = cols.drop_id_like(x, drop_id_like)
    kept = cols.drop_id_columns(kept, [c for c in cols.ID_COLUMNS if c != key])
    levels = fit_categories(kept, key, max_cardinality)
    encoded = cols.clean_features(cols.numeric_only(levels.apply(kept), key), key)
    features = [c for c in encoded.columns if c != key]
    labels = labelled_only(class_labels(y, key)).join(match_margins(y, y_supp, key), key)
    joined = labels.join(encoded, key, "left").na.fill(0.0, features)
    return cut_lineage(joined), features, levels


# -- forests by weighting scenario ------------------------------------------------------------


@dataclass
class ScenarioRun:
    run_name: str
    val_accuracy: float
    best_params: str
    model: Forest
    model_path: str | None = None
    importance_path: str | None = None


def weighting_scenarios(
    table: DataFrame,
    features: Sequence[str],
    *,
    scenarios: Sequence[dict] = SCENARIOS,
    grid: dict[str, Sequence] = FOREST_GRID,
    base: ForestSettings = ForestSettings(),
    folds: int = 3,
    parallelism: int = 4,
    key: str = "ID",
    out_dir: str | None = None,
) -> tuple[DataFrame, list[ScenarioRun]]:
    """Search, validate and compare one forest per weighting scheme on the same split and folds.

    Split, folds, the weights of all schemes and the feature vector are worked out once and written as one table, which all
    fits read. Returns the ranked comparison and the runs, best first. With ``out_dir`` models, metrics and importances are written, the best model
    also as ``best``.
    """
    spark = table.sparkSession
    parted = StratifiedSplit.fit(table, VALID_20, key=key).apply(table)
    train_folds = stratified_folds(parted.where("split = 'train'"), folds, key=key, seed=base.seed)
    weighted, schemes = train_folds.apply(parted, FOLD), []
    for i, scenario in enumerate(scenarios):
        options = {k: v for k, v in scenario.items() if k not in ("run_name", "scheme")}
        schemes.append(f"_weight_{i}")
        weighted = add_margin_weight(weighted, scenario["scheme"], **options).withColumnRenamed("weight", schemes[-1])
    written = shared_rows(weighted, features, [key, "split", FOLD, *schemes])
    train, runs = written.where("split = 'train'"), []
    bins = SharedBins(train, len(features), FOLD, schemes)
    for scenario, weight in zip(scenarios, schemes):
        found = grid_search(
            train, features, grid,
            base=base, folds=folds, weight=weight, key=key, parallelism=parallelism, fold=FOLD, bins=bins,
        )
        scored = found.model.score(written.where("split = 'valid'")).select(key, "label", "split", *PROBABILITIES, "prediction")
        run = ScenarioRun(scenario["run_name"], 0.0, str(asdict(found.best)), found.model)
        if out_dir:
            scored = cut_lineage(scored)
            folder = f"{out_dir}/{run.run_name}"
            run.model_path = Artifact(run.model).save(spark, f"{folder}/model")
            ranked = importance_table(run.model, spark).orderBy(F.desc("importance"))
            run.importance_path = write_report(ranked, f"{folder}/importances", "csv")
            report = run_report(scored, run.model, len(features), run_name=run.run_name, params=run.best_params)
            write_report(report, f"{folder}/metrics")
        run.val_accuracy = accuracy(scored).first()[0]
        runs.append(run)
    rows = [(r.run_name, r.val_accuracy, r.best_params, r.model_path, r.importance_path) for r in runs]
    results = spark.createDataFrame(
        rows, "run_name string, val_accuracy double, best_params string, model_path string, importance_path string"
    )
    winner = best_scenario(results).first()["run_name"]
    runs.sort(key=lambda r: (-r.val_accuracy, r.run_name))
    if out_dir:
        write_report(rank_scenarios(results), f"{out_dir}/weighting_compare", "csv")
        Artifact(next(r.model for r in runs if r.run_name == winner)).save(spark, f"{out_dir}/best")
    return rank_scenarios(results), runs


def run_report(
    scored: DataFrame,
    model: Forest | Boosted,
    n_features: int,
    k: int = 10,
    *,
    n_raw_features: int | None = None,
    run_name: str | None = None,
    params: str | None = None,
    splits: DataFrame | None = None,
) -> DataFrame:
    """Accuracy, confusion, per-class report and top features of one run, in one row.

    ``splits`` (split, accuracy, n_rows) adds the figures of all parts, ``n_raw_features`` the number
    of features before selection.
    """
    spark = scored.sparkSession
    confusion = confusion_matrix(scored)
    counted = confusion.orderBy("label").collect()
    # nine counts decide the report; the rows are not read again
    report = classification_report(spark.createDataFrame(counted, confusion.schema))
    top = [tuple(r) for r in top_features(importance_table(model, spark), k).select("feature", "importance").collect()]
    cells = [[int(r[f"predicted_{c}"]) for c in range(3)] for r in counted]
    total = sum(map(sum, cells))
    hits = sum(cells[i][i] for i in range(3))
    parts = [] if splits is None else [tuple(r) for r in splits.select("split", "accuracy", "n_rows").orderBy("split").collect()]
    row = (
        run_name, params, total, hits / total if total else None, n_raw_features or n_features, n_features, parts, cells,
        [tuple(r) for r in report.collect()], top,
    )
    return spark.createDataFrame(
        [row],
        "run_name string, params string, n_rows bigint, accuracy double, n_raw_features int, n_features int, "
        "splits array<struct<split:string,accuracy:double,n_rows:bigint>>, confusion array<array<bigint>>, "
        "report array<struct<class_name:string,precision:double,recall:double,f1:double,support:bigint>>, "
        "top_features array<struct<feature:string,importance:double>>",
    )


# -- boosted trees ------------------------------------------------------------------------------


@dataclass
class BoostRun:
    artifact: Artifact
    accuracies: DataFrame
    holdout: DataFrame
    permute: Callable[[], DataFrame | None]

    @cached_property
    def permutation(self) -> DataFrame | None:
        """Permutation importance, None if none was asked for. Rows are written and scored when it is first read."""
        return self.permute()


def boosted_run(
    table: DataFrame,
    features: Sequence[str],
    *,
    settings: BoostSettings = HISTOGRAM_BOOST,
    parts=HOLDOUT_10_VALID_20,
    select: bool = True,
    weights_from: str = "train",
    tune_draw: bool = False,
    permute_top: int | None = None,
    levels: CategoryLevels | None = None,
    key: str = "ID",
    out_dir: str | None = None,
) -> BoostRun:
    """Balanced weights, feature selection on train, early stopping on the validation part.

    ``weights_from`` is 'train' or 'all'. With ``tune_draw`` the draw factor is chosen on the
    validation part, kept with the model and applied to the holdout part. Permutation importance is
    measured for all features, or for the ``permute_top`` most important ones (0: none), and only when it is read. The split is
    written as a column, and the table is scored once.
    """
    if weights_from not in ("train", "all"):
        raise ValueError("weights_from must be 'train' or 'all'")
    parted = cut_lineage(StratifiedSplit.fit(table, parts, key=key).apply(table))
    train = parted.where("split = 'train'")
    raw, features, dropped = len(features), list(features), []
    if select:
        chosen = FeatureSelection.fit(train.select(key, *map(cols.quoted, features)))
        features, dropped = list(chosen.features), list(chosen.dropped)
    balance = ClassWeights.fit(train if weights_from == "train" else table)
    fitted_on = balance.apply(parted).where(F.col("split") != "holdout")
    model = fit_boosted(fitted_on.withColumn("_valid", F.col("split") == "valid"), features, settings, valid="_valid")
    scored = cut_lineage(model.score(parted).select(key, "label", "split", *PROBABILITIES, "prediction"))
    factor = best_draw_factor(scored.where("split = 'valid'")).first()["alpha"] if tune_draw else 1.0
    adjusted = argmax_class(apply_draw_factor(scored, factor)) if tune_draw else scored
    top = sorted(model.importances(), key=lambda f: (-f[1], f[0]))[:permute_top]

    def permute() -> DataFrame | None:
        return permutation_importance(model, parted.where("split = 'valid'"), [f for f, _ in top], key=key) if top else None

    run = BoostRun(
        Artifact(model, dropped, levels or CategoryLevels({}, ()), factor),
        accuracy_by_split(adjusted),
        adjusted.where("split = 'holdout'"),
        permute,
    )
    if out_dir:
        run.artifact.save(table.sparkSession, f"{out_dir}/model")
        write_report(run.accuracies, f"{out_dir}/accuracies")
        report = run_report(
            run.holdout, model, len(features), n_raw_features=raw, params=str(asdict(settings)), splits=run.accuracies
        )
        write_report(report, f"{out_dir}/metrics")
        if run.permutation is not None:
            write_report(run.permutation.orderBy(F.desc("importance")), f"{out_dir}/permutation", "csv")
    return run
