import random

import pytest
from conftest import rows
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from matchspark.models.nested import Cut, cut_forest, nested_accuracies, nested_votes, node_table, saved_forest
from matchspark.models.search import FOREST_GRID, combinations, families, grid_search
from matchspark.models.trees import Forest, ForestSettings, fit_forest, shared_rows
from matchspark.operators.evaluate import accuracy
from matchspark.session import scratch_path

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def ready(spark):
    rnd = random.Random(4)
    made = []
    for i in range(500):
        a, b, c = rnd.random(), rnd.random(), rnd.random()
        made.append((i, (int(3 * a) + int(2 * b) + rnd.choice([0, 0, 0, 1])) % 3, a, b, c, 1.0 + i % 3))
    return shared_rows(spark.createDataFrame(made, "ID int, label int, a double, b double, c double, weight double"), FEATURES, ["ID", "weight"])


def grown(ready, n_trees=3, depth=9, bootstrap=True, subset="all", leaf=1):
    made = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", numTrees=n_trees, maxDepth=depth, bootstrap=bootstrap,
        featureSubsetStrategy=subset, minInstancesPerNode=leaf, seed=5,
    )
    return made.fit(ready)


def plain(model, df):
    scored = Forest(model, FEATURES).score(df)
    return {r.ID: tuple(round(p, 9) for p in (r.p_home, r.p_draw, r.p_away)) for r in scored.select("ID", "p_home", "p_draw", "p_away").collect()}


@pytest.mark.parametrize("depth", [0, 1, 4, 9])
def test_cut_by_depth_equals_a_fit_of_that_depth(spark, ready, depth):
    """With all features and rows in every tree nothing is drawn, so the cut forest is the shallower one."""
    deep = grown(ready, bootstrap=False)
    made = cut_forest(spark, saved_forest(deep, spark), scratch_path(spark, "forest"), 3, Cut(depth))
    fitted = grown(ready, depth=depth, bootstrap=False)
    assert plain(made, ready) == plain(fitted, ready)
    assert made.totalNumNodes == fitted.totalNumNodes and made.trees[0].depth == fitted.trees[0].depth
    assert made.featureImportances == fitted.featureImportances


def brute_tree(nodes, x, cut):
    """Class shares for one row, from a tree that is cut and merged node by node."""

    def leaf(i, depth):
        at = nodes[i]
        return at.leftChild < 0 or depth == cut.max_depth or at.rawCount < cut.min_split or merged(at, depth)

    def merged(at, depth):
        l, r = at.leftChild, at.rightChild
        return leaf(l, depth + 1) and leaf(r, depth + 1) and nodes[l].prediction == nodes[r].prediction

    i, depth = 0, 0
    while not leaf(i, depth):
        at = nodes[i]
        left = x[at.split.featureIndex] <= at.split.leftCategoriesOrThreshold[0]
        i, depth = (at.leftChild if left else at.rightChild), depth + 1
    total = sum(nodes[i].impurityStats)
    return [v / total for v in nodes[i].impurityStats]


CUTS = [Cut(), Cut(2), Cut(None, 60), Cut(4, 25), Cut(0), Cut(None, 10_000)]


def test_votes_and_cut_forests_equal_a_walk_over_the_nodes(spark, ready):
    model = grown(ready, n_trees=5, subset="sqrt")
    path = saved_forest(model, spark)
    trees = {}
    for r in node_table(spark, path).collect():
        trees.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData
    votes = {r.ID: r.p for r in nested_votes(model, path, ready, CUTS, (2, 5), ["ID", "label"]).collect()}
    walked = {}
    for r in ready.collect():
        x = r.features.toArray()
        walked[r.ID] = [
            sum(brute_tree(trees[t], x, cut)[k] for t in range(n)) / n for n in (2, 5) for cut in CUTS for k in range(3)
        ]
    assert set(votes) == set(walked)
    assert all(votes[i] == pytest.approx(walked[i], abs=1e-9) for i in votes)
    found = nested_accuracies(model, path, ready, CUTS, (2, 5))
    for at, (n, cut) in enumerate((n, cut) for n in (2, 5) for cut in CUTS):
        made = cut_forest(spark, path, scratch_path(spark, "forest"), n, cut)
        assert made.getNumTrees == n and len(made.trees) == n
        assert plain(made, ready) == {i: tuple(round(p, 9) for p in v[3 * at : 3 * at + 3]) for i, v in walked.items()}
        assert found[n, cut] == pytest.approx(accuracy(Forest(made, FEATURES).score(ready)).first()[0])
    with pytest.raises(ValueError):
        nested_votes(model, path, ready, CUTS, (6,))


def test_min_split_makes_leaves_of_small_nodes(spark, ready):
    settings = ForestSettings(n_trees=4, max_depth=8, min_split=40)
    model = fit_forest(ready, FEATURES, settings).model
    nodes = node_table(spark, saved_forest(model, spark)).select("nodeData.*")
    assert nodes.where("leftChild >= 0").agg(F.min("rawCount")).first()[0] >= 40
    whole = fit_forest(ready, FEATURES, ForestSettings(n_trees=4, max_depth=8)).model
    assert whole.totalNumNodes > model.totalNumNodes > 4


def test_published_grid_is_twelve_forests_in_three_folds():
    grid = [ForestSettings(**v) for v in combinations(FOREST_GRID)]
    assert len(grid) == 48
    held = families(grid)
    assert len(held) == 4 and all(len(m) == 12 and g.n_trees == 400 and g.max_depth is None and g.min_split == 2 for g, m in held.items())


def test_search_over_nested_settings_equals_single_fits(spark, ready):
    """One tree per forest and all features: depth, leaves and splits decide alone, so fits of their own give the same."""
    grid = {"max_depth": (1, 5), "min_split": (2, 30), "min_leaf": (1, 20)}
    base = ForestSettings(n_trees=2, feature_subset="all")
    folded = ready.withColumn("fold", (F.col("ID") % 3).cast("string"))
    found = grid_search(folded, FEATURES, grid, base=base, fold="fold")
    assert [eval(p) for p, _ in found.table] == combinations(grid)
    assert found.best_accuracy == max(score for _, score in found.table)
    assert len(set(score for _, score in found.table)) > 3
    assert found.model.model.getNumTrees == 2
    repeat = grid_search(folded, FEATURES, {k: v[1:] for k, v in grid.items()}, base=base, fold="fold", parallelism=1)
    assert repeat.best_accuracy == pytest.approx(dict(found.table)[repeat.table[0][0]])


def test_shared_rows_split_small_tables_for_all_cores(spark, ready):
    assert ready.columns == ["label", "features", "ID", "weight"]
    assert rows(ready.agg(F.count("*"), F.sum("ID"))) == [(500, 124750)]
    assert shared_rows(ready.unionAll(ready), FEATURES, ["ID"]).rdd.getNumPartitions() >= 1
