import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchspark.models import grown, trees
from matchspark.models.artifact import Artifact
from matchspark.models.grown import GrownForest, drawn, grow_forest
from matchspark.models.importance import permutation_importance, placed, shuffles
from matchspark.models.nested import Cut
from matchspark.models.search import SharedBins, grid_search
from matchspark.models.trees import Forest, ForestSettings, fit_forest, shared_rows
from matchspark.operators.evaluate import accuracy

FEATURES = ["a", "b", "c", "d"]
CUTS = [Cut(), Cut(2), Cut(None, 40), Cut(0), Cut(4, 25)]


@pytest.fixture(scope="module")
def ready(spark):
    rnd = random.Random(4)
    made = []
    for i in range(600):
        a, b, c, d = (rnd.randrange(9) for _ in FEATURES)
        label = (a // 3 + b // 5 + rnd.choice([0, 0, 0, 1])) % 3
        made.append((i, label, float(a), float(b), float(c), float(d), 1.0 + i % 3))
    frame = spark.createDataFrame(made, "ID int, label int, a double, b double, c double, d double, weight double")
    return shared_rows(frame, FEATURES, ["ID", "weight"])


def numbered(ready):
    return ready.withColumn("_row", F.col("ID").cast("bigint"))


def votes(forest, ready, cuts):
    return {(r["_row"], r["tree"]): r["shares"] for r in forest.votes(numbered(ready), cuts).collect()}


def brute(x, label, weight, times, cut, min_leaf, depth=0):
    """(function from a row to shares, predicted class, is leaf) of a tree that tries all features, split by split."""
    sums = [sum(w * t for w, t, k in zip(weight, times, label) if k == c) for c in range(3)]
    leaf = ((lambda row: [s / sum(sums) for s in sums]), max(range(3), key=lambda c: sums[c]), True)

    def squares(at):
        s = np.bincount(label[at], (weight * times)[at], 3)
        return (s * s).sum() / s.sum()

    best = (1e-12, None, None)
    everything = np.ones(len(label), bool)
    for j in range(x.shape[1]):
        for limit in sorted(set(x[:, j]))[:-1]:
            left = x[:, j] <= limit
            if min(times[left].sum(), times[~left].sum()) >= min_leaf:
                gain = (squares(left) + squares(~left) - squares(everything)) / sum(sums)
                if gain > best[0] + 1e-15:
                    best = (gain, j, limit)
    if best[1] is None or depth == cut.max_depth or times.sum() < cut.min_split:
        return leaf
    _, j, limit = best
    left = x[:, j] <= limit
    l, r = (brute(x[s], label[s], weight[s], times[s], cut, min_leaf, depth + 1) for s in (left, ~left))
    if l[2] and r[2] and l[1] == r[1]:
        return leaf
    return (lambda row: (l if row[j] <= limit else r)[0](row)), None, False


@pytest.mark.parametrize("rows_a_group", [10_000, 100])
def test_trees_equal_a_plain_recursion(spark, ready, monkeypatch, rows_a_group):
    """All cuts of trees that try all features, whole or in branches; only leaves on both sides of a border may differ in shares."""
    monkeypatch.setattr(grown, "ROWS_A_GROUP", rows_a_group)
    settings = ForestSettings(n_trees=3, feature_subset="all", min_leaf=2)
    forest = grow_forest(ready.withColumn("_id", F.col("ID")), FEATURES, settings, 30)
    # the forest numbers rows by itself; its draws are taken from the rows as they lie
    lying = ready.select(F.monotonically_increasing_id().alias("_row"), "ID", "label", "weight", "features").orderBy("_row").collect()
    x, label = np.array([r.features.toArray() for r in lying]), np.array([int(r.label) for r in lying])
    weight, times = np.array([r.weight for r in lying]), drawn(np.array([r["_row"] for r in lying]), np.arange(3), settings.seed)
    found = votes(forest, ready, CUTS)
    assert len(found) == 3 * len(lying)
    assert (max(forest.tops.depth) > 0) == (rows_a_group == 100)
    for t in range(3):
        keep = times[:, t] > 0
        for at, cut in enumerate(CUTS):
            walk = brute(x[keep], label[keep], weight[keep], times[keep, t], cut, 2)[0]
            for r in lying:
                wanted, got = walk(r.features.toArray()), found[r.ID, t][3 * at : 3 * at + 3]
                if rows_a_group == 10_000:
                    assert got == pytest.approx(wanted, abs=1e-9)
                else:
                    assert np.argmax(got) == np.argmax(wanted) and sum(got) == pytest.approx(1.0)


def test_branches_draw_what_whole_trees_draw(ready, monkeypatch):
    settings = ForestSettings(n_trees=6, min_leaf=3)
    whole = grow_forest(ready, FEATURES, settings, 30)
    monkeypatch.setattr(grown, "ROWS_A_GROUP", 60)
    parted = grow_forest(ready, FEATURES, settings, 30)
    a, b = votes(whole, ready, [Cut()]), votes(parted, ready, [Cut()])
    assert a.keys() == b.keys() and len(a) == 3600
    assert all(np.argmax(a[k]) == np.argmax(b[k]) for k in a)
    assert sum(v for _, v in parted.importances()) == pytest.approx(1.0)


def test_large_forests_are_tables_and_as_good(spark, ready, monkeypatch, tmp_path):
    settings = ForestSettings(n_trees=40, min_leaf=3)
    held, train = ready.where("ID % 4 = 0"), ready.where("ID % 4 <> 0")
    small = fit_forest(train, FEATURES, settings)
    monkeypatch.setattr(trees, "NODES_IN_MEMORY", 100)
    large = fit_forest(train, FEATURES, settings)
    assert isinstance(small, Forest) and isinstance(large, GrownForest)
    assert accuracy(large.score(held)).first()[0] == pytest.approx(accuracy(small.score(held)).first()[0], abs=0.06)
    for (name, x), (same, y) in zip(large.importances(), small.importances()):
        assert name == same and x == pytest.approx(y, abs=0.06)
    scored = large.score(held)
    assert scored.columns == [*held.columns, "p_home", "p_draw", "p_away", "prediction"] and scored.count() == 150
    Artifact(large).save(spark, str(tmp_path / "m"))
    loaded = Artifact.load(spark, str(tmp_path / "m")).model
    kept = ["ID", "p_home", "p_draw", "p_away", "prediction"]
    assert rows(loaded.score(held), *kept) == rows(scored, *kept) and loaded.importances() == large.importances()
    assert fit_forest(train, FEATURES, settings).importances() == large.importances()


def test_search_scores_large_forests_as_cut_ones(ready, monkeypatch):
    monkeypatch.setattr(trees, "NODES_IN_MEMORY", 100)
    folded = ready.withColumn("fold", (F.col("ID") % 3).cast("string"))
    grid = {"n_trees": (2, 5), "max_depth": (None, 3), "min_split": (2, 30)}
    found = grid_search(folded, FEATURES, grid, fold="fold", base=ForestSettings(feature_subset="all"))
    alone = grid_search(folded, FEATURES, {"n_trees": (5,), "max_depth": (3,), "min_split": (30,)}, fold="fold", base=ForestSettings(feature_subset="all"))
    assert len(found.table) == 8 and found.best_accuracy == max(v for _, v in found.table) > 0.6
    assert dict(found.table)[alone.table[0][0]] == pytest.approx(alone.best_accuracy, abs=0.02)


def test_a_search_bins_each_fold_once_and_on_all_cores(spark, ready, monkeypatch):
    """The rows of a fold are binned for all families and weights together, from as many parts as there are cores."""
    monkeypatch.setattr(trees, "NODES_IN_MEMORY", 100)
    seen, real = [], grown.thresholds
    monkeypatch.setattr(grown, "thresholds", lambda rows, *rest: seen.append(rows.select(F.spark_partition_id()).distinct().count()) or real(rows, *rest))
    folded = ready.coalesce(1).withColumn("fold", (F.col("ID") % 2).cast("string"))
    folded = folded.withColumn("other", F.lit(1.0))
    bins = SharedBins(folded, len(FEATURES), "fold", ["weight", "other"])
    grid = {"n_trees": (3,), "min_leaf": (1, 2), "feature_subset": ("sqrt", "all")}
    found = [grid_search(folded, FEATURES, grid, folds=2, fold="fold", weight=w, bins=bins) for w in ("weight", "other")]
    assert len(seen) == 3 and min(seen) >= 4
    monkeypatch.setattr(grown, "thresholds", real)
    alone = grid_search(folded, FEATURES, grid, folds=2, fold="fold", weight="other")
    assert found[1].table == alone.table and found[1].table != found[0].table


def test_votes_travel_by_block_and_trees_of_moderate_size_have_no_top(ready):
    """One row per tree, branch and block of rows, not per vote; 600 rows are grown in one group per tree."""
    forest = grow_forest(ready, FEATURES, ForestSettings(n_trees=6), 30)
    assert grown.rows_a_group(38) == 131_072 and grown.rows_a_group(10_000) == 16_384
    # the bytes of a batch are counted in 32 bits
    assert all(10_000 * grown.trees_a_pass(p) * (p + 32) < 2**31 for p in (4, 38, 2118, 10_000, 100_000))
    told = forest._packed_votes(numbered(ready), [Cut()]).select("tree", F.length("votes").alias("n")).collect()
    assert len(told) == 6 and sum(r["n"] for r in told) == 3600 * grown.vote_kind([Cut()]).itemsize


def test_one_bin_features_and_equal_rows_end_as_leaves(spark, monkeypatch):
    """Rows no feature can part stay in the top, however many they are."""
    monkeypatch.setattr(grown, "ROWS_A_GROUP", 20)
    frame = spark.range(200).selectExpr("cast(id % 3 as int) as label", "1.0D as a", "2.0D as b", "1.0D as weight", "cast(id as int) as ID")
    alike = shared_rows(frame, ["a", "b"], ["ID", "weight"])
    forest = grow_forest(alike, ["a", "b"], ForestSettings(n_trees=4), 30)
    assert all(forest.tops.ended)
    assert forest.score(alike).count() == 200 and forest.importances() == [("a", 0.0), ("b", 0.0)]


@pytest.mark.parametrize("rows_a_group", [10_000, 80])
def test_permutation_equals_scoring_every_shuffled_row(ready, monkeypatch, rows_a_group):
    monkeypatch.setattr(grown, "ROWS_A_GROUP", rows_a_group)
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array("features")
    table = ready.select("ID", "label", "weight", *[values[i].alias(c) for i, c in enumerate(FEATURES)])
    forest = grow_forest(ready, FEATURES, ForestSettings(n_trees=9, min_leaf=2), 30)
    found = {r["feature"]: r for r in permutation_importance(forest, table, ["a", "c"], repeats=2, buckets=8).collect()}
    put = placed(table, "ID", 8)
    base = accuracy(forest.score(put)).first()[0]
    scored = forest.score(shuffles(put, ["a", "c"], "ID", [42, 43]))
    hit = F.avg((F.col("label").cast("int") == F.col("prediction")).cast("int"))
    wanted = {}
    for r in scored.groupBy("shuffled", "repeat").agg(hit.alias("hit")).collect():
        wanted.setdefault(r["shuffled"], []).append(base - r["hit"])
    assert set(found) == {"a", "c"} and found["a"]["importance"] > 0.05
    for f, drops in wanted.items():
        assert found[f]["importance"] == pytest.approx(np.mean(drops), abs=2e-3) and found[f]["spread"] == pytest.approx(np.std(drops), abs=2e-3)


def made_rows(n: int, p: int, seed: int):
    rng = np.random.default_rng(seed)
    columns = rng.integers(0, 9, (p, n)).astype(np.uint8)
    times = rng.integers(1, 4, n)
    return columns, rng.integers(0, 3, n), np.exp(0.2 * rng.integers(0, 5, n)) * times, times


@pytest.mark.parametrize("min_leaf", [1, 3])
def test_small_nodes_split_by_order_as_by_histogram(monkeypatch, min_leaf):
    """To the last bit, also with weights whose sums hang on their order."""
    columns, label, weight, times = made_rows(900, 6, 1)
    rule = grown.Rule(6, 3, 9, min_leaf, 2, 30)
    by_order = grown.grow_branch(columns, label, weight, times, 5, 0, rule)
    monkeypatch.setattr(grown, "FEW_ROWS", 0)
    by_histogram = grown.grow_branch(columns, label, weight, times, 5, 0, rule)
    assert len(by_order["left"]) > 100 and all(np.array_equal(by_order[c], by_histogram[c]) for c in by_order)


def test_rows_travel_in_few_bytes():
    """Bins take the bits they need, and a vote for a pure leaf doesn't carry its shares."""
    limits = [np.arange(n) for n in (31, 1, 0, 254, 5, 31, 31, 2)]
    words = grown.Words.of(limits)
    columns = np.stack([np.arange(500) % (len(v) + 1) for v in limits]).astype(np.uint8)
    assert words.n == 2 and np.array_equal(words.columns(words.pack(columns, 500)), columns)
    ids = np.array([70, 3, 66, 5])
    table = np.array([[0.0, 1.0, 0.0], [0.25, 0.5, 0.25]])
    packed = grown.packed_votes(ids, 7, [table, table], [np.array([0, 1, 1, 0]), np.zeros(4, int)], 64)
    parts = grown.pa.table(packed, grown.VOTES)
    assert grown.vote_kind([Cut()]).itemsize == 4 and [len(v.as_py()) for v in parts.column("shares")] == [24, 24]
    found, of, shares = grown.told_votes(parts, grown.vote_kind([Cut(), Cut(1)]))
    got = {int(64 * parts.column("block")[int(o)].as_py() + f["row"]): shares[f["leaf"]].tolist() for f, o in zip(found, of)}
    assert got == {70: [[0, 1, 0], [0, 1, 0]], 3: [[0.25, 0.5, 0.25], [0, 1, 0]], 66: [[0.25, 0.5, 0.25], [0, 1, 0]], 5: [[0, 1, 0], [0, 1, 0]]}


def test_a_swap_is_walked_only_where_it_leaves_the_path():
    columns, label, weight, times = made_rows(400, 5, 2)
    b = grown.grow_branch(columns, label, weight, times, 9, 0, grown.Rule(5, 2, 9, 1, 2, 30))
    step = grown.steps(b["feature"], b["bin"], b["left"])
    node, low, high = grown.paths_of(columns, step)
    assert np.array_equal(node, grown.leaves_of(columns, step)) and (b["left"][node] < 0).all()
    for f in range(5):
        other = np.roll(columns[f], 1)
        swapped = columns.copy()
        swapped[f] = other
        now = grown.leaves_of(columns, step, 0, np.arange(400), (np.full(400, f), other))
        assert np.array_equal(now, grown.leaves_of(swapped, step))
        assert np.array_equal(now != node, (other <= low[f]) | (other > high[f]))
