"""Bounded samples of labelled rows that the classifiers learn from, and a small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Classes a label column may have; their counts come to the driver.
MOST_CLASSES = 1000
_RANGE = 1 << 40


def sample_labels(labels: DataFrame, doc_id: str, label: str, per_class: int, salt: int = 0) -> DataFrame:
    """About ``per_class`` (doc_id, label) rows of every class, picked by a hash of the id.

    Rows without id or label are left out; of rows that repeat an id, the smallest label counts. The
    number of rows is a parameter and doesn't grow with the table: at most ``per_class`` times the
    number of classes, give or take the spread of a hash.
    """
    one = labels.where(F.col(f"`{doc_id}`").isNotNull() & F.col(f"`{label}`").isNotNull()).groupBy(
        F.col(f"`{doc_id}`").alias("s_id")
    ).agg(F.min(f"`{label}`").alias("s_label"))
    counts = {r.s_label: r.n for r in one.groupBy("s_label").agg(F.count("*").alias("n")).limit(MOST_CLASSES + 1).collect()}
    if len(counts) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} classes")
    if not counts:
        return one
    draw = F.pmod(F.xxhash64(F.col("s_id"), F.lit(salt)), F.lit(_RANGE))
    share = None
    for value, n in counts.items():
        here, cut = F.col("s_label") == F.lit(value), F.lit(min(_RANGE, _RANGE * per_class // n))
        share = F.when(here, cut) if share is None else share.when(here, cut)
    return one.where(draw < share)


def sampled_texts(docs: DataFrame, sample: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(s_id, s_label, text) of the sampled rows. The sample is broadcast: its size is bounded by parameter."""
    found = docs.select(F.col(f"`{doc_id}`").alias("d_id"), F.col(f"`{text}`").alias("text"))
    return found.join(F.broadcast(sample), F.col("d_id") == F.col("s_id")).select("s_id", "s_label", "text")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Coefficients (last one the constant) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ beta)
        grad = x.T @ (weight * (p - y)) + ridge * beta
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        beta -= step * min(1.0, 4.0 / size) if size > 0 else step
        if size < 1e-7:
            break
    return beta
