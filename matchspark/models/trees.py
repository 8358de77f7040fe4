"""Tree ensembles over three classes on Spark ML, and their class probabilities."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from matchspark.functions.expressions import top_class
from matchspark.functions.text import tick
from matchspark.models.grown import BinnedRows, GrownForest, grow_binned, grow_forest
from matchspark.models.nested import Cut, best_round, cut_boosted, cut_forest, round_by_gain, saved_forest
from matchspark.models.rounds import grow_rounds
from matchspark.operators.evaluate import CLASSES, PROBABILITIES
from matchspark.session import cut_lineage, scratch_path

DEEPEST = 30  # Spark ML's limit; None stands for it
ROWS_A_FILE, FEW_ROWS = 200_000, 500
NODES_IN_MEMORY = 200_000  # of a whole forest; beyond, it is grown and kept as a table
ROWS_BY_CLASS = 200_000  # beyond, boosted trees of all classes are grown side by side


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the feature vector, in exactly this order. Expects cleaned columns, or rows that have the vector already."""
    if "features" in df.columns and isinstance(df.schema["features"].dataType, VectorUDT):
        return df
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)


def shared_rows(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep``, a double ``label`` and the feature vector, written once for many fits.

    Files grow in number with the rows, so that every fit finds work for all cores, and none finds a file of more than
    ``ROWS_A_FILE`` rows.
    """
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    files = max(math.ceil(rows / ROWS_A_FILE), min(cores, math.ceil(rows / FEW_ROWS)), 1)
    ready = assemble(df.withColumn("label", F.col("label").cast("double")), features)
    return cut_lineage(ready.select("label", "features", *[tick(c) for c in keep if c != "label"]).repartition(files))


def _plain(scored: DataFrame, source: DataFrame) -> DataFrame:
    """Drop the model's working columns and add the most likely class."""
    return scored.select(
        *[tick(c) for c in source.columns],
        *PROBABILITIES,
        top_class(*map(F.col, PROBABILITIES)).alias("prediction"),
    )


# -- random forest ------------------------------------------------------------------------


@dataclass(frozen=True)
class ForestSettings:
    n_trees: int = 200
    max_depth: int | None = None
    min_leaf: int = 1
    min_split: int = 2
    feature_subset: str = "sqrt"
    seed: int = 42
    max_bins: int = 32
    max_memory_mb: int = 512

    def __post_init__(self) -> None:
        if self.max_depth is not None and self.max_depth > DEEPEST:
            raise ValueError(f"max_depth {self.max_depth} is beyond {DEEPEST}, the deepest tree Spark ML grows")

    def estimator(self, weight: str | None) -> RandomForestClassifier:
        forest = RandomForestClassifier(
            labelCol="label",
            featuresCol="features",
            numTrees=self.n_trees,
            maxDepth=DEEPEST if self.max_depth is None else self.max_depth,
            minInstancesPerNode=self.min_leaf,
            featureSubsetStrategy=self.feature_subset,
            seed=self.seed,
            maxBins=self.max_bins,
            maxMemoryInMB=self.max_memory_mb,
            cacheNodeIds=True,
            checkpointInterval=10,
        )
        return forest.setWeightCol(weight) if weight else forest


@dataclass
class Forest:
    model: RandomForestClassificationModel
    features: list[str]
    kind: str = field(default="forest", init=False)

    def score(self, df: DataFrame) -> DataFrame:
        """Add p_home, p_draw, p_away and prediction."""
        if self.model.numClasses != len(CLASSES):
            raise ValueError(f"the model knows {self.model.numClasses} classes, not {len(CLASSES)}")
        out = self.model.transform(assemble(df, self.features))
        p = vector_to_array("probability")
        return _plain(out.select("*", *[p[k].alias(name) for k, name in enumerate(PROBABILITIES)]), df)

    def importances(self) -> list[tuple[str, float]]:
        return _named(self.features, self.model.featureImportances.toArray())

    def models(self) -> list:
        return [self.model]


def fit_forest(
    train: DataFrame, features: Sequence[str], settings: ForestSettings, weight: str | None = "weight", shared: Callable[[int], BinnedRows] | None = None
) -> Forest | GrownForest:
    """Train on columns ``label``, ``weight`` and the features, or the feature vector of :func:`shared_rows`.

    Nodes of fewer than ``min_split`` rows are made leaves after growing; nothing below such a node could have been kept. A forest
    that may have more than ``NODES_IN_MEMORY`` nodes is grown as a table (see ``models/grown.py``), from the same rows in so many bins that
    ``shared`` gives, if it is there.
    """
    rows = assemble(train.withColumn("label", F.col("label").cast("double")), features)
    depth = DEEPEST if settings.max_depth is None else settings.max_depth
    rows = rows.select("label", "features", *([weight] if weight else []))
    if settings.n_trees * 2 ** (depth + 1) > NODES_IN_MEMORY and settings.max_bins <= 256:
        if 2 * settings.n_trees * rows.count() / settings.min_leaf > NODES_IN_MEMORY:
            if shared:
                return grow_binned(shared(settings.max_bins), features, settings, depth, weight)
            weighted = rows.withColumn("weight", F.col(weight) if weight else F.lit(1.0))
            return grow_forest(weighted, features, settings, depth)
    grown = settings.estimator(weight).fit(rows)
    if settings.min_split > 2:
        spark = train.sparkSession
        grown = cut_forest(spark, saved_forest(grown, spark), scratch_path(spark, "forest"), settings.n_trees, Cut(None, settings.min_split))
    return Forest(grown, list(features))


# -- boosted trees, one model per class ------------------------------------------------------


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 5
    min_leaf: int = 1
    min_gain: float = 0.0
    row_share: float = 1.0
    feature_subset: str = "all"
    early_stopping: float = 0.01
    patience: int | None = None
    l1: float = 0.0
    l2: float = 0.0
    seed: int = 42
    max_bins: int = 32
    max_memory_mb: int = 512

    def estimator(self, label: str, weight: str | None, valid: str | None) -> GBTClassifier:
        boosted = GBTClassifier(
            labelCol=label,
            featuresCol="features",
            maxIter=self.rounds,
            stepSize=self.learning_rate,
            maxDepth=self.max_depth,
            minInstancesPerNode=self.min_leaf,
            minInfoGain=self.min_gain,
            subsamplingRate=self.row_share,
            featureSubsetStrategy=self.feature_subset,
            validationTol=self.early_stopping,
            seed=self.seed,
            maxBins=self.max_bins,
            maxMemoryInMB=self.max_memory_mb,
            checkpointInterval=10,
        )
        if weight:
            boosted = boosted.setWeightCol(weight)
        return boosted.setValidationIndicatorCol(valid) if valid else boosted


# The two published parameter sets.
HISTOGRAM_BOOST = BoostSettings(rounds=800, learning_rate=0.03, max_depth=4, min_leaf=200, l2=5.0)
TUNED_BOOST = BoostSettings(
    rounds=5000, learning_rate=0.05, max_depth=10, min_leaf=200, min_gain=0.05,
    row_share=0.7, feature_subset="0.6", max_bins=255, patience=100, l1=0.5, l2=5.0,
)


@dataclass
class Boosted:
    """Each model tells one class from the other two; its probabilities are normalised."""

    per_class: list[GBTClassificationModel]
    features: list[str]
    kind: str = field(default="boosted", init=False)

    def score(self, df: DataFrame) -> DataFrame:
        if len(self.per_class) != len(CLASSES):
            raise ValueError(f"{len(self.per_class)} models for {len(CLASSES)} classes")
        out = assemble(df, self.features)
        raw = []
        for k, model in enumerate(self.per_class):
            out = (
                model.setProbabilityCol(f"_p{k}").setRawPredictionCol(f"_r{k}").setPredictionCol(f"_c{k}").transform(out)
            )
            raw.append(vector_to_array(f"_p{k}")[1])
        total = sum(raw[1:], raw[0])
        return _plain(out.select("*", *[(p / total).alias(name) for p, name in zip(raw, PROBABILITIES)]), df)

    def importances(self) -> list[tuple[str, float]]:
        summed = sum(m.featureImportances.toArray() for m in self.per_class) / len(self.per_class)
        return _named(self.features, summed)

    def models(self) -> list:
        return self.per_class

    def rounds_used(self) -> list[int]:
        return [m.getNumTrees for m in self.per_class]


def fit_boosted(
    train: DataFrame, features: Sequence[str], settings: BoostSettings, weight: str | None = "weight", valid: str | None = None
) -> Boosted:
    """``valid`` names a boolean column; its rows only decide when to stop.

    With ``patience`` that many rounds without a smaller validation loss end an ensemble, which keeps its rounds up to the best
    one; each class decides for itself. Spark ML grows rounds in runs of doubling length, since its growing can't be resumed; from more than
    ``ROWS_BY_CLASS`` rows they are grown one by one, for all classes at once (see ``models/rounds.py``).
    """
    spark = train.sparkSession
    if settings.patience and not valid:
        raise ValueError("patience needs validation rows")
    keep = [c for c in (weight, valid) if c]
    if settings.max_bins <= 256 and train.count() > ROWS_BY_CLASS:
        return _fit_side_by_side(train, features, settings, weight, valid)
    flags = [(F.col("label").cast("int") == k).cast("double").alias(f"_is{k}") for k in CLASSES]
    rows = assemble(train, features).select("features", *keep, *flags)
    if settings.patience:
        rows = cut_lineage(rows)
        grown, judged = rows.where(~F.col(valid)), rows.where(F.col(valid))

    def shortened(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
        return cut_boosted(spark, saved_forest(model, spark), scratch_path(spark, "boosted"), rounds, settings.l1, settings.l2)

    def fit(k: int) -> GBTClassificationModel:
        if not settings.patience:
            model = settings.estimator(f"_is{k}", weight, valid).fit(rows)
            return shortened(model, model.getNumTrees) if settings.l1 or settings.l2 else model
        rounds, stopped = 2 * settings.patience, False
        while True:
            rounds = min(rounds, settings.rounds)
            model = settings.estimator(f"_is{k}", weight, None).setMaxIter(rounds).fit(grown)
            losses = model.evaluateEachIteration(judged)
            kept, stopped = best_round(losses, settings.patience)
            if stopped or rounds == settings.rounds:
                return shortened(model, kept)
            rounds *= 2

    # three independent chains of small jobs; together they fill the executors
    with ThreadPoolExecutor(max_workers=len(CLASSES)) as pool:
        models = list(pool.map(inheritable_thread_target(spark)(fit), CLASSES))
    return Boosted(models, list(features))


def _fit_side_by_side(train: DataFrame, features: Sequence[str], settings: BoostSettings, weight: str | None, valid: str | None) -> Boosted:
    spark = train.sparkSession
    weights, judged = F.col(weight).cast("double") if weight else F.lit(1.0), F.col(valid) if valid else F.lit(False)
    rows = assemble(train, features).select(F.col("label").cast("int").alias("label"), weights.alias("weight"), judged.alias("valid"), "features")
    by_gain = lambda losses: round_by_gain(losses, settings.early_stopping)
    by_patience = lambda losses: best_round(losses, settings.patience)
    decide = (by_patience if settings.patience else by_gain) if valid else None
    saved = grow_rounds(rows, len(features), settings, decide, lambda few: settings.estimator("label", "weight", None).setMaxIter(1).fit(few))
    return Boosted([cut_boosted(spark, s.path, scratch_path(spark, "boosted"), s.kept, settings.l1, settings.l2) for s in saved], list(features))


def _named(features: Sequence[str], values) -> list[tuple[str, float]]:
    return [(name, float(v)) for name, v in zip(features, values)]


def importance_table(model: Forest | GrownForest | Boosted, spark) -> DataFrame:
    """``position, feature, importance``; position is the training order."""
    rows = [(i, name, value) for i, (name, value) in enumerate(model.importances())]
    return spark.createDataFrame(rows, "position int, feature string, importance double")
