"""Accuracy, confusion, reports and draw calibration over a scored table.

A scored table has ``label`` and, where needed, ``prediction`` and ``p_home, p_draw, p_away``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspark.functions.expressions import CLASS_NAMES, scale_draw, top_class
from matchspark.operators.columns import quoted

PROBABILITIES = ("p_home", "p_draw", "p_away")

# Draw factors tried in turn, and class codes.
DRAW_FACTORS = (0.9, 1.0, 1.05, 1.1, 1.15, 1.2, 1.3)
CLASSES = (0, 1, 2)


def _hit(label: Column, prediction: Column) -> Column:
    return (label.cast("int") == prediction.cast("int")).cast("int")


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.agg(F.avg(_hit(quoted(label), quoted(prediction))).alias("accuracy"))


def accuracy_by_split(scored: DataFrame, split: str = "split") -> DataFrame:
    """Accuracy and size of every part."""
    return scored.groupBy(split).agg(
        F.avg(_hit(F.col("label"), F.col("prediction"))).alias("accuracy"), F.count(F.lit(1)).alias("n_rows")
    )


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence[int] = CLASSES) -> DataFrame:
    """A row per true class and a column per predicted class, on the full fixed grid."""
    grid = scored.sparkSession.createDataFrame([(c,) for c in classes], "label int")
    predicted = quoted(prediction).cast("int")
    counted = scored.groupBy(quoted(label).cast("int").alias("label")).agg(
        *[F.count_if(predicted == c).alias(f"predicted_{c}") for c in classes]
    )
    names = [f"predicted_{c}" for c in classes]
    return grid.join(counted, "label", "left").na.fill(0, names).select("label", *names)


def classification_report(confusion: DataFrame, classes: Sequence[int] = CLASSES, names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted average.

    Works on the confusion matrix alone, folded to one row. A division by zero gives 0.
    """
    cell = {
        (t, p): F.max(F.when(F.col("label") == t, F.col(f"predicted_{p}"))) for t in classes for p in classes
    }
    one_row = confusion.agg(*[agg.alias(f"c_{t}_{p}") for (t, p), agg in cell.items()])
    at = lambda t, p: F.col(f"c_{t}_{p}")
    add = lambda items: sum(items[1:], items[0])
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    measured = {}
    for c in classes:
        hits, support = at(c, c), add([at(c, p) for p in classes])
        precision, recall = share(hits, add([at(t, c) for t in classes])), share(hits, support)
        measured[c] = (precision, recall, share(2 * precision * recall, precision + recall), support)
    total = add([measured[c][3] for c in classes])
    rate = share(add([at(c, c) for c in classes]), total)
    macro = [add([measured[c][i] for c in classes]) / len(classes) for i in range(3)]
    weighted = [share(add([measured[c][i] * measured[c][3] for c in classes]), total) for i in range(3)]

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class_name"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.alias("support"),
        )

    lines = [line(name, *measured[c]) for c, name in zip(classes, names)]
    lines.append(line("accuracy", rate, rate, rate, total))
    lines.append(line("macro avg", *macro, total))
    lines.append(line("weighted avg", *weighted, total))
    return one_row.select(F.inline(F.array(*lines)))


# -- draw calibration -----------------------------------------------------------------


def apply_draw_factor(scored: DataFrame, alpha: float, columns: Sequence[str] = PROBABILITIES) -> DataFrame:
    adjusted = dict(zip(columns, scale_draw(*map(quoted, columns), alpha)))
    return scored.select(*[adjusted[c].alias(c) if c in adjusted else quoted(c) for c in scored.columns])


def draw_factor_accuracies(scored: DataFrame, factors: Sequence[float] = DRAW_FACTORS, label: str = "label") -> DataFrame:
    """``position, alpha, accuracy`` for every factor, all from one pass."""
    p = [quoted(c) for c in PROBABILITIES]
    one_row = scored.agg(
        *[
            F.avg(_hit(quoted(label), top_class(*scale_draw(*p, a)))).alias(f"a{i}")
            for i, a in enumerate(factors)
        ]
    )
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(float(a)).alias("alpha"), F.col(f"a{i}").alias("accuracy"))
        for i, a in enumerate(factors)
    ]
    return one_row.select(F.inline(F.array(*cells)))


def best_draw_factor(scored: DataFrame, factors: Sequence[float] = DRAW_FACTORS, label: str = "label") -> DataFrame:
    """The most accurate factor; the first of the list among equals, 1 without any row."""
    return (
        draw_factor_accuracies(scored, factors, label)
        .orderBy(F.desc("accuracy"), "position")
        .limit(1)
        .select(F.when(F.col("accuracy").isNull(), 1.0).otherwise(F.col("alpha")).alias("alpha"), "accuracy")
    )


# -- rankings ---------------------------------------------------------------------------


def top_features(importances: DataFrame, k: int = 30) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(k)


def rank_scenarios(results: DataFrame) -> DataFrame:
    return results.orderBy(F.desc("val_accuracy"), "run_name")


def best_scenario(results: DataFrame) -> DataFrame:
    return rank_scenarios(results).limit(1)
