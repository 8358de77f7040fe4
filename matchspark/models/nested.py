"""Smaller ensembles inside a grown one, from its node table.

A forest grown to the greatest depth holds every shallower one: a node at the cut becomes a leaf, for which its class counts
are stored. So does one whose nodes need more rows to be split, and one of fewer trees. ``nested_accuracies`` scores rows once by their leaves and gives
the accuracy of all such forests; ``cut_forest`` writes one of them as a model of its own.

With all features tried at every split and no row sampling, a cut forest equals one grown with that depth. Otherwise it is
another forest of the same kind, since growing draws features and rows in an order that depends on depth and number of trees.
A node's rows are counted as drawn, repeats included and weights aside.

``cut_boosted`` does the same for the rounds of a boosted ensemble: a longer one begins with the trees of a shorter one. It can also
shrink the leaves. A leaf's value is the sum of its rows' gradients over the sum of their weights, which the node table holds; with
penalties it is the sum, moved towards 0 by ``l1``, over the weights and ``l2``. Trees are not grown anew, so penalties
reach the leaves but not the choice of splits.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from matchspark.functions.expressions import top_class
from matchspark.operators.columns import quoted
from matchspark.operators.evaluate import CLASSES
from matchspark.session import scratch_path, workers_find_package


@dataclass(frozen=True)
class Cut:
    """Greatest depth (None: as grown) and rows a node needs to be split."""

    max_depth: int | None = None
    min_split: int = 2


def saved_forest(model: RandomForestClassificationModel | GBTClassificationModel, spark: SparkSession) -> str:
    path = scratch_path(spark, "forest")
    model.write().save(path)
    return path


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """(treeID, nodeData) of a saved forest, one row per node; ids of a tree are numbered from its root down, left first."""
    return spark.read.parquet(f"{path}/data")


def _children(tree: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Nodes of a tree in order, and their children's places (-1: leaf)."""
    nodes = pa.table(tree.column("nodeData").combine_chunks().flatten(), [f.name for f in tree.schema.field("nodeData").type])
    nodes = nodes.sort_by("id")
    return nodes, nodes.column("leftChild").to_numpy(), nodes.column("rightChild").to_numpy()


def _levels(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(depth, inner nodes of that depth), from the root down."""
    level, depth = np.zeros(1, np.int64), 0
    while len(level):
        inner = level[left[level] >= 0]
        yield depth, inner
        level, depth = np.concatenate([left[inner], right[inner]]).astype(np.int64), depth + 1


def _stands_for(nodes: pa.Table, left: np.ndarray, right: np.ndarray, cut: Cut) -> np.ndarray:
    rows, predicted = (nodes.column(c).to_numpy() for c in ("rawCount", "prediction"))
    return stands_for(rows, predicted, left, right, cut)


def stands_for(rows: np.ndarray, predicted: np.ndarray, left: np.ndarray, right: np.ndarray, cut: Cut) -> np.ndarray:
    """For every node the one that is its leaf in the cut tree; itself where the cut tree has it.

    As when a tree is grown, two leaves of one parent that predict the same class become one.
    """
    ends = (left < 0) | (rows < cut.min_split)
    levels = list(_levels(left, right))
    for depth, inner in reversed(levels):
        l, r = left[inner], right[inner]
        ends[inner] |= (depth == cut.max_depth) | (ends[l] & ends[r] & (predicted[l] == predicted[r]))
    stands = np.arange(len(left))
    for _, inner in levels:
        ended = inner[ends[inner] | (stands[inner] != inner)]
        stands[left[ended]] = stands[right[ended]] = stands[ended]
    return stands


def leaf_shares(nodes: DataFrame, cuts: Sequence[Cut]) -> DataFrame:
    """(tree, leaf, shares): class shares of every leaf under each cut, one after the other. Leaves count from the left."""
    workers_find_package(nodes.sparkSession)
    ddl = "tree int, leaf int, shares array<double>"

    def run(key: tuple, tree: pa.Table) -> pa.Table:
        table, left, right = _children(tree)
        counts = np.array(table.column("impurityStats").to_pylist())
        total = counts.sum(1, keepdims=True)
        shares = np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)
        leaves = np.flatnonzero(left < 0)
        made = np.hstack([shares[_stands_for(table, left, right, cut)[leaves]] for cut in cuts])
        columns = [np.full(len(leaves), key[0].as_py(), np.int32), np.arange(len(leaves), dtype=np.int32), made.tolist()]
        return pa.table([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.list_(pa.float64()))], ["tree", "leaf", "shares"])

    return nodes.groupBy("treeID").applyInArrow(run, ddl)


def nested_votes(
    model: RandomForestClassificationModel, path: str, rows: DataFrame, cuts: Sequence[Cut], tree_counts: Sequence[int], keep: Sequence[str] = ("label",)
) -> DataFrame:
    """``keep`` of every row and ``p``: class probabilities of every (tree count, cut), in this order, one after the other.

    ``rows`` have the feature vector. They are scored once; a row meets its leaf of each tree in the leaf table.
    """
    if max(tree_counts) > model.getNumTrees:
        raise ValueError(f"{max(tree_counts)} trees wanted of {model.getNumTrees}")
    spark, size = rows.sparkSession, len(cuts) * len(CLASSES)
    shares = leaf_shares(node_table(spark, path).where(F.col("treeID") < max(tree_counts)), cuts)
    leaves = model.setLeafCol("_leaves").transform(rows.select("features", *map(quoted, keep)))
    numbered = leaves.select(F.monotonically_increasing_id().alias("_row"), *map(quoted, keep), vector_to_array("_leaves").alias("_leaves"))
    visits = numbered.select("_row", *map(quoted, keep), F.posexplode("_leaves").alias("_tree", "_leaf"))
    voted = visits.join(shares, (F.col("_tree") == F.col("tree")) & (F.col("_leaf").cast("int") == F.col("leaf")))
    sums = [F.sum(F.when(F.col("tree") < n, F.col("shares")[i])) / F.lit(float(n)) for n in tree_counts for i in range(size)]
    return voted.groupBy("_row", *map(quoted, keep)).agg(F.array(*sums).alias("p")).drop("_row")


def nested_accuracies(
    model: RandomForestClassificationModel, path: str, rows: DataFrame, cuts: Sequence[Cut], tree_counts: Sequence[int]
) -> dict[tuple[int, Cut], float]:
    """Accuracy on ``rows`` of the forest of each number of trees under each cut."""
    n = len(CLASSES)
    votes = nested_votes(model, path, rows, cuts, tree_counts)
    settings = [(count, cut) for count in tree_counts for cut in cuts]
    guesses = [top_class(*[F.col("p")[k * n + c] for c in range(n)]) for k in range(len(settings))]
    hits = votes.agg(*[F.avg((F.col("label").cast("int") == guess).cast("int")).alias(f"a{k}") for k, guess in enumerate(guesses)]).first()
    return dict(zip(settings, hits))


def cut_forest(spark: SparkSession, source: str, target: str, n_trees: int, cut: Cut) -> RandomForestClassificationModel:
    """Write the first ``n_trees`` of a saved forest under a cut as a forest of its own, and load it."""
    workers_find_package(spark)
    nodes = node_table(spark, source).where(F.col("treeID") < n_trees)
    arrow = to_arrow_schema(nodes.schema)

    def run(key: tuple, tree: pa.Table) -> pa.Table:
        table, left, right = _children(tree)
        stands = _stands_for(table, left, right, cut)
        kept = np.flatnonzero(stands == np.arange(len(stands)))
        place = np.full(len(stands), -1)
        place[kept] = np.arange(len(kept))
        # Both children of a node that ends stand for it.
        inner = (left[kept] >= 0) & (stands[left[kept]] == left[kept])
        changed = {
            "id": np.arange(len(kept)), "leftChild": np.where(inner, place[left[kept]], -1), "rightChild": np.where(inner, place[right[kept]], -1),
            "gain": np.where(inner, table.column("gain").to_numpy()[kept], -1.0),
        }
        none = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        splits = [s if i else none for s, i in zip(table.column("split").take(pa.array(kept)).to_pylist(), inner)]
        data = arrow.field("nodeData").type
        columns = [
            pa.array(splits if f.name == "split" else changed[f.name], f.type)
            if f.name == "split" or f.name in changed
            else table.column(f.name).take(pa.array(kept)).combine_chunks().cast(f.type)
            for f in data
        ]
        ids = pa.array(np.full(len(kept), key[0].as_py()), arrow.field("treeID").type)
        return pa.table([ids, pa.StructArray.from_arrays(columns, fields=list(data))], schema=arrow)

    nodes.groupBy("treeID").applyInArrow(run, nodes.schema).write.parquet(f"{target}/data")
    _write_rest(spark, source, target, n_trees, cut.max_depth)
    return RandomForestClassificationModel.load(target)


def _write_rest(spark: SparkSession, source: str, target: str, n_trees: int, max_depth: int | None = None) -> None:
    """Tree weights and settings of the first ``n_trees``."""
    trees = spark.read.parquet(f"{source}/treesMetadata")
    trees.where(F.col(f"`{trees.columns[0]}`") < n_trees).write.parquet(f"{target}/treesMetadata")
    told = json.loads("".join(r.value for r in spark.read.text(f"{source}/metadata").collect()))
    told["numTrees"] = n_trees
    told["paramMap"].update({k: n_trees for k in ("numTrees", "maxIter") if k in told["paramMap"]})
    if max_depth is not None:
        told["paramMap"]["maxDepth"] = min(max_depth, told["paramMap"]["maxDepth"])
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{target}/metadata")


def shrunken(total: Column, weight: Column, l1: float, l2: float) -> Column:
    """Value of a leaf whose rows' gradients sum to ``total``, under both penalties."""
    return F.signum(total) * F.greatest(F.abs(total) - F.lit(l1), F.lit(0.0)) / (weight + F.lit(l2))


def cut_boosted(spark: SparkSession, source: str, target: str, rounds: int, l1: float = 0.0, l2: float = 0.0) -> GBTClassificationModel:
    """Write the first ``rounds`` of a saved boosted ensemble, with shrunken leaves if there are penalties, and load it."""
    nodes = node_table(spark, source).where(F.col("treeID") < rounds)
    if l1 or l2:
        told = F.col("nodeData.impurityStats")
        leaf = (F.col("nodeData.leftChild") < 0) & (told[0] > 0)
        value = F.when(leaf, shrunken(told[1], told[0], l1, l2)).otherwise(F.col("nodeData.prediction"))
        nodes = nodes.withColumn("nodeData", F.col("nodeData").withField("prediction", value))
    nodes.write.parquet(f"{target}/data")
    _write_rest(spark, source, target, rounds)
    return GBTClassificationModel.load(target)


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Number of rounds to keep, and whether ``patience`` rounds in a row after it brought no smaller loss."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def round_by_gain(losses: Sequence[float], tolerance: float) -> tuple[int, bool]:
    """The same by Spark ML's rule: it stops at the first round that doesn't lower the loss by the share ``tolerance`` (of 0.01 at least)."""
    best, kept = losses[0], 1
    for at, loss in enumerate(losses[1:], 2):
        if best - loss < tolerance * max(loss, 0.01):
            return kept, True
        if loss < best:
            best, kept = loss, at
    return kept, False
