"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspark.functions.expressions import CLASS_NAMES
from matchspark.functions.text import named, tick
from matchspark.operators import columns as cols
from matchspark.operators import dedup, evaluate, joins, profile, weights
from matchspark.operators.encode import fit_categories
from matchspark.operators.rollup import roll_up, roll_up_mean_first
from matchspark.operators.select import correlated_columns, upper_correlations, varying_columns
from matchspark.operators.split import HOLDOUT_10_VALID_20, VALID_20, VALID_20_HOLDOUT_16, StratifiedSplit, stratified_folds
from matchspark.operators.submission import SHORT_NAMES, argmax_class, submission
from matchspark.queries import bindings as b
from matchspark.models.artifact import Artifact
from matchspark.models.importance import permutation_importance, placed, shuffles
from matchspark.models.search import FOREST_GRID, grid_search
from matchspark.models.trees import (
    HISTOGRAM_BOOST,
    TUNED_BOOST,
    BoostSettings,
    ForestSettings,
    fit_boosted,
    fit_forest,
    importance_table,
    shared_rows,
)
from matchspark.plans.merge import merge_matches
from matchspark.plans.notebook import exploratory_merge
from matchspark.plans.predict import predict
from matchspark.plans.train import boosted_run, run_report, training_table, weighting_scenarios
from matchspark.session import cut_lineage, fine_partitions, scratch_path
from matchspark.sources import files
from matchspark.sources.bucketed import buckets_for, write_bucketed
from matchspark.streaming.rollup import STATE_KEYS, compact_rollup, latest_rollup, read_through, stream_misfits, stream_moments, stream_rollup, stream_tiers, stream_wide_rollup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to a fixed number of digits, so that summation order does not show."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.selectExpr(*[named(f"round({tick(c)}, {digits})", c) if c in doubles else tick(c) for c in df.columns])


# -- merged table -----------------------------------------------------------------------


@query("merged_table")
def merged_table(spark, sf_dir):
    return rounded(joins.match_table(*b.sides(spark, sf_dir)))


@query("merged_table_lenient")
def merged_table_lenient(spark, sf_dir):
    return rounded(joins.lenient_match_table(*b.sides(spark, sf_dir)))


@query("merged_table_mixed")
def merged_table_mixed(spark, sf_dir):
    return rounded(joins.mixed_match_table(*b.sides(spark, sf_dir)))


def mixed(spark, sf_dir) -> DataFrame:
    """The merged table other queries build on, before rounding."""
    return joins.mixed_match_table(*b.sides(spark, sf_dir))


def merged_splits(spark, sf_dir) -> dict[str, DataFrame]:
    """The merged train and test tables; together they hold every match."""
    merged = mixed(spark, sf_dir)
    ids = {"train": b.train_ids(spark, sf_dir), "test": b.test_ids(spark, sf_dir)}
    return {name: merged.join(known, "ID", "left_semi") for name, known in ids.items()}


# -- player roll-ups ----------------------------------------------------------------------


@query("player_rollup_sample")
def player_rollup_sample(spark, sf_dir):
    return rounded(roll_up(b.players(spark, sf_dir), prefix="player_"))


@query("player_rollup_rowcount_pop")
def player_rollup_rowcount_pop(spark, sf_dir):
    return rounded(roll_up(b.players(spark, sf_dir), prefix="player_", moments="population_rows"))


@query("player_rollup_notebook")
def player_rollup_notebook(spark, sf_dir):
    return rounded(roll_up_mean_first(b.players(spark, sf_dir), prefix="player_"))


@query("player_rollup_chunked")
def player_rollup_chunked(spark, sf_dir):
    return rounded(roll_up(b.players(spark, sf_dir), prefix="player_", strategy="chunked", chunk_size=3))


@query("wide_player_rollup")
def wide_player_rollup(spark, sf_dir):
    wide, names = b.vectors(spark, sf_dir)
    return rounded(roll_up(wide.select(F.col("label").alias("ID"), *names), prefix="p_"))


# -- joins --------------------------------------------------------------------------------


@query("raw_player_rows")
def raw_player_rows(spark, sf_dir):
    home, away, home_player, away_player = b.sides(spark, sf_dir)
    return joins.stacked_players(joins.join_one_to_one(home, away), home_player, away_player)


@query("raw_player_fanout")
def raw_player_fanout(spark, sf_dir):
    home, _, home_player, away_player = b.sides(spark, sf_dir)
    return joins.fan_out(home, home_player, away_player)


@query("validated_one_to_one")
def validated_one_to_one(spark, sf_dir):
    return joins.join_one_to_one(b.home_team(spark, sf_dir), b.away_team(spark, sf_dir))


@query("align_labels")
def align_labels(spark, sf_dir):
    return joins.align_to_ids(b.train_ids(spark, sf_dir), b.y(spark, sf_dir))


@query("align_labels_missing")
def align_labels_missing(spark, sf_dir):
    aligned = joins.align_to_ids(b.train_ids(spark, sf_dir), b.y(spark, sf_dir))
    return joins.missing_rows(aligned, CLASS_NAMES, "missing_labels")


@query("align_labels_supp")
def align_labels_supp(spark, sf_dir):
    return joins.align_to_ids(b.train_ids(spark, sf_dir), b.y_supp(spark, sf_dir))


@query("label_semi")
def label_semi(spark, sf_dir):
    return cols.canonical_labels(joins.keep_known_ids(b.y(spark, sf_dir), b.train_ids(spark, sf_dir)))


@query("xy_left")
def xy_left(spark, sf_dir):
    return joins.analysis_table(b.home_team(spark, sf_dir), b.y(spark, sf_dir), b.y_supp(spark, sf_dir))


@query("xy_feature_left")
def xy_feature_left(spark, sf_dir):
    features = roll_up(b.players(spark, sf_dir))
    joined = joins.labelled_features(b.y(spark, sf_dir), features)
    return rounded(joined.na.fill(0.0, [c for c in features.columns if c not in ("ID", "player_count")]).na.fill(0, ["player_count"]))


# -- duplicates and keys ------------------------------------------------------------------


@query("dedup_exact")
def dedup_exact(spark, sf_dir):
    return dedup.drop_exact_duplicates(b.repeated_orders(spark, sf_dir, 0.0))


@query("dedup_first_by_id")
def dedup_first_by_id(spark, sf_dir):
    return dedup.first_per_key(b.repeated_orders(spark, sf_dir, 1.0), "ID", ["o_totalprice"])


@query("dedup_removed")
def dedup_removed(spark, sf_dir):
    repeated = b.repeated_orders(spark, sf_dir, 0.0).unionByName(b.repeated_orders(spark, sf_dir, 1.0))
    return dedup.removed_counts(repeated)


@query("id_uniqueness")
def id_uniqueness(spark, sf_dir):
    names = ("home_team", "away_team", "home_player", "away_player")
    return dedup.uniqueness_report(dict(zip(names, b.sides(spark, sf_dir))))


@query("id_overlap")
def id_overlap(spark, sf_dir):
    return joins.overlap_count(b.train_ids(spark, sf_dir), b.test_ids(spark, sf_dir, b.OVERLAP_FROM))


# -- profiling ----------------------------------------------------------------------------


@query("class_distribution")
def class_distribution(spark, sf_dir):
    return rounded(profile.class_distribution(b.y(spark, sf_dir)), 6)


@query("majority_baseline")
def majority_baseline(spark, sf_dir):
    return rounded(profile.majority_baseline(b.y(spark, sf_dir)), 6)


@query("describe_percentiles")
def describe_percentiles(spark, sf_dir):
    goals = profile.describe_column(b.y_supp(spark, sf_dir), "GOAL_DIFF_HOME_AWAY")
    prices = profile.describe_column(b.home_team(spark, sf_dir), "o_totalprice")
    named = [df.withColumn("feature", F.lit(name)) for name, df in (("goal_diff", goals), ("o_totalprice", prices))]
    return rounded(profile.union_all(named))


@query("histogram31")
def histogram31(spark, sf_dir):
    goals = profile.histogram(b.y_supp(spark, sf_dir), "GOAL_DIFF_HOME_AWAY")
    prices = profile.histogram(b.home_team(spark, sf_dir), "o_totalprice")
    named = [df.withColumn("feature", F.lit(name)) for name, df in (("goal_diff", goals), ("o_totalprice", prices))]
    return rounded(profile.union_all(named))


@query("missing_ratio_top30")
def missing_ratio_top30(spark, sf_dir):
    return rounded(profile.top_missing(mixed(spark, sf_dir)), 6)


@query("feature_overview")
def feature_overview(spark, sf_dir):
    tables = merged_splits(spark, sf_dir)
    missing = [profile.columns_with_missing(df).withColumn("dataset", F.lit(name)) for name, df in tables.items()]
    return profile.feature_type_counts(tables).join(profile.union_all(missing), ["dataset", "n_features"])


@query("variance_top_bottom")
def variance_top_bottom(spark, sf_dir):
    # large variances have more digits than a sum in any order keeps
    v = F.col("variance")
    return profile.variance_extremes(mixed(spark, sf_dir)).withColumn("variance", F.when(v > 1e6, F.round(v, -4)).otherwise(F.round(v, 2)))


@query("corr_targets_topk")
def corr_targets_topk(spark, sf_dir):
    xy = joins.analysis_table(mixed(spark, sf_dir), b.y(spark, sf_dir), b.y_supp(spark, sf_dir))
    return rounded(profile.top_target_correlations(xy), 6)


@query("shape_summary")
def shape_summary(spark, sf_dir):
    merged = merged_splits(spark, sf_dir)
    tables = {
        "train_merged": merged["train"],
        "test_merged": merged["test"],
        "y_train_aligned": joins.align_to_ids(b.train_ids(spark, sf_dir), b.y(spark, sf_dir)),
        "y_train_supp_aligned": joins.align_to_ids(b.train_ids(spark, sf_dir), b.y_supp(spark, sf_dir)),
    }
    return profile.shape_summary(tables)


@query("constant_columns")
def constant_columns(spark, sf_dir):
    items = b.table(spark, sf_dir, "lineitem")
    shown = items.select(
        F.col("l_orderkey").alias("ID"), "l_quantity", "l_linestatus", "l_returnflag", F.lit("EUR").alias("currency"),
        F.when(F.col("l_tax") >= 0, F.lit(1)).alias("taxed"),
        F.when(F.col("l_quantity") > 25, F.lit(1)).alias("large"),
        F.when(F.col("l_quantity") < 0, F.lit(1)).alias("never"),
    )
    return profile.constant_columns(shown)


@query("distinct_counts")
def distinct_counts(spark, sf_dir):
    orders = b.home_team(spark, sf_dir)
    return profile.distinct_counts(orders, ["o_custkey", "o_orderpriority", "o_totalprice"])


# -- selection ----------------------------------------------------------------------------


@query("corr_matrix_upper")
def corr_matrix_upper(spark, sf_dir):
    wide, names = b.vectors(spark, sf_dir)
    return rounded(upper_correlations(wide.select(*names)), 5)


def selectable(spark, sf_dir) -> DataFrame:
    """Numeric merged features without gaps, two of them nearly the same and one nearly constant."""
    table = cols.numeric_only(mixed(spark, sf_dir))
    extra = table.select(
        "*",
        (F.col("home_teamo_totalprice") * 1.08 + F.col("home_teamo_custkey")).alias("price_with_fee"),
        (F.col("home_player_l_tax_mean") * 0.001).alias("tax_share"),
    )
    # the matrix takes several passes
    return cut_lineage(cols.clean_features(extra, as_float=False))


@query("corr_drop_list")
def corr_drop_list(spark, sf_dir):
    dropped = correlated_columns(selectable(spark, sf_dir))
    return spark.createDataFrame([(c,) for c in dropped], "feature string")


@query("variance_select")
def variance_select(spark, sf_dir):
    kept = varying_columns(selectable(spark, sf_dir))
    return spark.createDataFrame(list(enumerate(kept)), "position int, feature string")


# -- labels and weights ---------------------------------------------------------------------


@query("onehot_to_class")
def onehot_to_class(spark, sf_dir):
    aligned = joins.align_to_ids(b.home_team(spark, sf_dir), b.y(spark, sf_dir))
    strict = weights.class_labels(aligned)
    lenient = weights.class_labels(aligned, unlabelled="home").withColumnRenamed("label", "label_home_default")
    return strict.join(lenient, "ID")


@query("win_margin")
def win_margin(spark, sf_dir):
    return weights.match_margins(b.y(spark, sf_dir), b.y_supp(spark, sf_dir))


@query("margin_weights")
def margin_weights(spark, sf_dir):
    df = weights.match_margins(b.y(spark, sf_dir), b.y_supp(spark, sf_dir))
    df = weights.add_margin_weight(df, "none", "weight_none")
    df = weights.add_margin_weight(df, "linear", "weight_linear", beta=0.25)
    return rounded(weights.add_margin_weight(df, "exp", "weight_exp", alpha=0.2, cap=5.0))


@query("weight_stats")
def weight_stats(spark, sf_dir):
    margins = weights.match_margins(b.y(spark, sf_dir), b.y_supp(spark, sf_dir))
    linear = weights.weight_summary(weights.add_margin_weight(margins, "linear"), name="linear_small")
    exp = weights.weight_summary(weights.add_margin_weight(margins, "exp", cap=5.0), name="exp_soft")
    return rounded(linear.unionByName(exp))


@query("balanced_weights")
def balanced_weights(spark, sf_dir):
    labelled = b.labelled(spark, sf_dir)
    return rounded(weights.ClassWeights.fit(labelled).apply(labelled), 8)


# -- cleaning and encoding ------------------------------------------------------------------


@query("numeric_coerce")
def numeric_coerce(spark, sf_dir):
    raw = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"),
        "o_totalprice",
        F.col("o_custkey").cast("string").alias("customer_text"),
        "o_orderpriority",
        F.substring("o_orderpriority", 1, 1).alias("priority_text"),
        "o_orderdate",
        (F.col("o_totalprice") > 250000).alias("large"),
    )
    return cols.coerce_numeric(raw)


@query("clean_features")
def clean_features(spark, sf_dir):
    """What survives the drops of text, id-like and named id columns, cleaned."""
    marked = mixed(spark, sf_dir).withColumns({"GAME_ID": F.col("home_teamo_custkey"), "season": F.lit(1)})
    table = cols.drop_id_columns(cols.drop_id_like(cols.drop_text(marked)[0]), ["season"])
    odd = table.withColumn(
        "odd",
        F.when(F.col("away_teamc_acctbal") > 9000, float("inf"))
        .when(F.col("away_teamc_acctbal") < 0, float("nan"))
        .otherwise(F.col("away_teamc_acctbal")),
    )
    return cols.clean_features(odd)


@query("encode_categoricals")
def encode_categoricals(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    customers = b.table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("ID"), "o_orderdate", "o_totalprice", "c_name", "c_mktsegment",
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("o_orderpriority"),
        (F.col("o_totalprice") > 250000).alias("large"),
    )
    train = joined.where(F.col("o_orderdate") < F.lit(b.TEST_FROM))
    test = joined.where(F.col("o_orderdate") >= F.lit(b.TEST_FROM))
    fitted = fit_categories(train)
    coded = [fitted.apply(df).withColumn("part", F.lit(part)) for part, df in (("train", train), ("test", test))]
    return coded[0].unionByName(coded[1]).drop("o_orderdate")


@query("score_mixed_types")
def score_mixed_types(spark, sf_dir):
    """Levels fitted on texts, applied to a table where the same columns hold numbers and truth values."""
    orders = b.table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    train = orders.select(
        F.col("o_orderkey").alias("ID"), F.concat(F.lit("Y"), year).alias("year"), F.col("o_orderstatus").alias("large"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
    ).unionByName(orders.select(F.col("o_orderkey").alias("ID"), year.cast("string").alias("year"),
        (F.col("o_totalprice") > 250000).cast("string").alias("large"), F.lit("2.0").alias("priority")))
    test = orders.select(
        F.col("o_orderkey").alias("ID"), year.alias("year"), (F.col("o_totalprice") > 250000).alias("large"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
    )
    return fit_categories(train).apply(test)


@query("align_features")
def align_features(spark, sf_dir):
    features = ["c_acctbal", "not_in_test", "o_totalprice"]
    test = b.home_team(spark, sf_dir).join(b.away_team(spark, sf_dir), "ID")
    return cols.match_features(test, features)


@query("common_columns")
def common_columns(spark, sf_dir):
    train, test = cols.common_columns(b.home_player(spark, sf_dir), roll_up(b.away_player(spark, sf_dir)))
    home, away = cols.common_columns(
        b.home_player(spark, sf_dir), b.away_player(spark, sf_dir).drop("l_tax"), cols.find_key(train, test)
    )
    return home.unionByName(away)


# -- splits ---------------------------------------------------------------------------------


def _split(spark, sf_dir, parts) -> DataFrame:
    # matches without a label keep their row and get no part
    rows = weights.class_labels(b.y(spark, sf_dir))
    return StratifiedSplit.fit(rows, parts).apply(rows)


@query("stratified_split_70_20_10")
def stratified_split_70_20_10(spark, sf_dir):
    return _split(spark, sf_dir, HOLDOUT_10_VALID_20)


@query("stratified_split_64_16_20")
def stratified_split_64_16_20(spark, sf_dir):
    return _split(spark, sf_dir, VALID_20_HOLDOUT_16)


@query("stratified_split_80_20")
def stratified_split_80_20(spark, sf_dir):
    return _split(spark, sf_dir, VALID_20)


@query("stratified_folds_3")
def stratified_folds_3(spark, sf_dir):
    rows = weights.class_labels(b.y(spark, sf_dir))
    return stratified_folds(rows, 3).apply(rows, "fold")


@query("feature_shuffle")
def feature_shuffle(spark, sf_dir):
    prices = b.home_team(spark, sf_dir).select("ID", "o_totalprice", "o_custkey")
    return shuffles(placed(prices, "ID"), ["o_totalprice", "o_custkey"], "ID", [42, 43]).drop("_bucket")


class QuantityRule:
    """A fixed scoring rule in place of a model: the class by quantity; the price plays no part."""

    features = ["q", "o_totalprice"]

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.when(F.col("q") > 60, 0).when(F.col("q") > 20, 1).otherwise(2))


@query("permutation_of_rule")
def permutation_of_rule(spark, sf_dir):
    q = b.players(spark, sf_dir).groupBy("ID").agg(F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("q"))
    prices = b.home_team(spark, sf_dir).select("ID", "o_totalprice")
    valid = b.labelled(spark, sf_dir).join(prices, "ID").join(q, "ID", "left").na.fill(0.0, ["q"])
    return rounded(permutation_importance(QuantityRule(), valid, repeats=2), 8)


# -- evaluation and submission ----------------------------------------------------------------


@query("draw_alpha")
def draw_alpha(spark, sf_dir):
    return rounded(evaluate.apply_draw_factor(b.scored(spark, sf_dir), 1.2), 8)


@query("tune_draw_alpha")
def tune_draw_alpha(spark, sf_dir):
    return rounded(evaluate.best_draw_factor(b.scored(spark, sf_dir)), 8)


@query("draw_alpha_accuracies")
def draw_alpha_accuracies(spark, sf_dir):
    return rounded(evaluate.draw_factor_accuracies(b.scored(spark, sf_dir)), 8)


@query("accuracy")
def accuracy(spark, sf_dir):
    return rounded(evaluate.accuracy(argmax_class(b.scored(spark, sf_dir))), 8)


@query("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(argmax_class(b.scored(spark, sf_dir)))


@query("classification_report")
def classification_report(spark, sf_dir):
    confusion = evaluate.confusion_matrix(argmax_class(b.scored(spark, sf_dir)))
    return rounded(evaluate.classification_report(confusion), 8)


@query("submission_onehot")
def submission_onehot(spark, sf_dir):
    return submission(b.scored(spark, sf_dir))


@query("submission_proba")
def submission_proba(spark, sf_dir):
    order = ("AWAY_WINS", "DRAW", "HOME_WINS")
    out = submission(b.scored(spark, sf_dir), as_probabilities=True, order=order, names=SHORT_NAMES)
    return rounded(out, 8)


# -- streaming ------------------------------------------------------------------------------


@query("streaming_rollup")
def streaming_rollup(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "rollup"), scratch_path(spark, "rollup-progress")
    stream_rollup(b.player_file_stream(spark, sf_dir), out, checkpoint, prefix="player_").awaitTermination()
    return rounded(latest_rollup(spark, out))


@query("streaming_wide_rollup")
def streaming_wide_rollup(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "wide"), scratch_path(spark, "wide-progress")
    running, wide = stream_wide_rollup(b.vector_stream(spark, sf_dir), out, checkpoint)
    running.awaitTermination()
    base = compact_rollup(spark, out, 0, scratch_path(spark, "wide-base"), STATE_KEYS)
    return rounded(wide.rollup("p_", after=0, base=base))


@query("streaming_state_merge")
def streaming_state_merge(spark, sf_dir):
    folder, checkpoint = scratch_path(spark, "moments"), scratch_path(spark, "moments-progress")
    running, state = stream_moments(b.player_file_stream(spark, sf_dir), folder, checkpoint)
    running.awaitTermination()
    # batches 0 and 1 are compacted, the later ones are added to that
    base = state.compact(1, scratch_path(spark, "moments-base"))
    return rounded(state.rollup("player_", after=1, base=base))


@query("streaming_tiers")
def streaming_tiers(spark, sf_dir):
    """Ten micro-batches whose tables are folded on the way, three by three."""
    folder, checkpoint = scratch_path(spark, "tiers"), scratch_path(spark, "tiers-progress")
    running, state = stream_tiers(b.player_file_stream(spark, sf_dir, batches=10), folder, checkpoint, fanout=3)
    running.awaitTermination()
    return rounded(state.rollup("player_"))


@query("csv_stream_rollup")
def csv_stream_rollup(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "csv-rollup"), scratch_path(spark, "csv-progress")
    stream_rollup(b.player_csv_stream(spark, sf_dir), out, checkpoint, prefix="player_").awaitTermination()
    return rounded(latest_rollup(spark, out))


@query("csv_stream_misfits")
def csv_stream_misfits(spark, sf_dir):
    """Cells that didn't fit, counted by the stream while it reads."""
    running = read_through(b.player_csv_stream(spark, sf_dir), scratch_path(spark, "csv-progress"))
    running.awaitTermination()
    return spark.createDataFrame(sorted(stream_misfits(running).items()), "feature string, n_misfits bigint")


# -- sources and sinks ------------------------------------------------------------------------


@query("csv_round_trip")
def csv_round_trip(spark, sf_dir):
    flag = F.col("l_returnflag")
    note = (
        F.when(flag == "R", F.concat(F.lit('say ""hi"", "'), "l_linestatus", F.lit('" ok')))
        .when(flag == "A", F.concat(F.lit(" two\nlines, "), F.col("l_linenumber").cast("string"), F.lit(' " ')))
        .otherwise("N/A")
    )
    items = b.table(spark, sf_dir, "lineitem")
    noted = items.select(F.col("l_orderkey").alias("ID"), "l_quantity", note.alias("note"), F.round(F.col("l_tax") * 100).alias("l_tax"))
    path = files.write_table(noted, scratch_path(spark, "players"), "csv")
    return files.read_csv(spark, path, multiline=True).select("*", F.col("l_tax").cast("double").alias("tax"))


@query("csv_late_types")
def csv_late_types(spark, sf_dir):
    """Whole numbers first, decimals only in later rows."""
    orders = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ID"), "o_totalprice")
    middle = orders.agg(F.avg("ID")).first()[0]
    late = F.when(F.col("ID") > middle, F.col("o_totalprice").cast("string"))
    early = F.floor("o_totalprice").cast("string")
    mixed_rows = orders.select("ID", F.coalesce(late, early).alias("price"))
    path = files.write_table(mixed_rows, scratch_path(spark, "late"), "csv", sort_by="ID")
    return files.read_player_csv(spark, path)


@query("goal_csv")
def goal_csv(spark, sf_dir):
    path = files.write_table(b.y_supp(spark, sf_dir), scratch_path(spark, "goals"), "csv")
    return files.read_goal_differences(spark, path)


@query("merge_from_csv")
def merge_from_csv(spark, sf_dir):
    """Raw CSV folders through discovery, merge and label alignment; both splits and the aligned labels."""
    folder = scratch_path(spark, "raw")
    names = ("home_team", "away_team", "home_player", "away_player")
    for split, ids in (("train", b.train_ids(spark, sf_dir)), ("test", b.test_ids(spark, sf_dir))):
        for name, df in zip(names, b.sides(spark, sf_dir)):
            files.write_table(df.join(ids, "ID", "left_semi"), f"{folder}/{split}/{split}_{name}_statistics.csv", "csv")
    y_path = files.write_table(b.y(spark, sf_dir), f"{folder}/y.csv", "csv")
    supp_path = files.write_table(b.y_supp(spark, sf_dir), f"{folder}/supp.csv", "csv")
    paths = merge_matches(spark, f"{folder}/train", f"{folder}/test", f"{folder}/out", y_path, supp_path)
    merged = {name: spark.read.parquet(paths[name]) for name in ("train", "test", "y_train_aligned", "y_train_supp_aligned")}
    labels = merged["y_train_aligned"].join(merged["y_train_supp_aligned"], "ID")
    train = merged["train"].join(labels, "ID", "left").withColumn("part", F.lit("train"))
    return rounded(train.unionByName(merged["test"].withColumn("part", F.lit("test")), allowMissingColumns=True))


@query("label_csv")
def label_csv(spark, sf_dir):
    path = files.write_table(b.y(spark, sf_dir), scratch_path(spark, "labels"), "csv")
    return files.read_labels(spark, path)


@query("merged_written")
def merged_written(spark, sf_dir):
    table = rounded(joins.match_table(*b.sides(spark, sf_dir)))
    train = table.join(b.train_ids(spark, sf_dir), "ID", "left_semi")
    test = table.join(b.test_ids(spark, sf_dir), "ID", "left_semi")
    paths = files.write_merged(train, test, scratch_path(spark, "merged"))
    parts = [spark.read.parquet(paths[p]).withColumn("part", F.lit(p)) for p in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query("bucketed_tables")
def bucketed_tables(spark, sf_dir):
    """The merged table and both label tables written by key, then joined as they lie."""
    made = (rounded(mixed(spark, sf_dir)), b.y(spark, sf_dir), b.y_supp(spark, sf_dir))
    buckets = buckets_for(made[1])
    x, y, supp = (spark.table(write_bucketed(df, scratch_path(spark, "bucketed"), buckets=buckets)) for df in made)
    return joins.analysis_table(x, y, supp)


@query("exploratory_merge")
def exploratory_merge_of_orders(spark, sf_dir):
    """The exploratory merge under another key name: both splits, train beside its labels."""
    splits = []
    for ids in (b.train_ids(spark, sf_dir), b.test_ids(spark, sf_dir)):
        tables = [df.join(ids, "ID", "left_semi").withColumnRenamed("ID", "match_id") for df in b.sides(spark, sf_dir)]
        splits.append([tables[0].withColumn("season", F.lit(7)), *tables[1:]])
    merged = exploratory_merge(splits[0], splits[1], b.y(spark, sf_dir))
    train = merged["train"].join(merged["labels"].withColumnRenamed("id", "match_id"), "match_id", "left").withColumn("part", F.lit("train"))
    with fine_partitions(spark):
        train = cut_lineage(train)
    return rounded(train.unionByName(merged["test"].withColumn("part", F.lit("test")), allowMissingColumns=True))


@query("file_discovery")
def file_discovery(spark, sf_dir):
    found = files.discover_file(spark, sf_dir, "lineitem", ".parquet")
    return files.read_table(spark, found).groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n_rows"))


@query("schema_summary")
def schema_summary(spark, sf_dir):
    summary = profile.schema_summary(merged_splits(spark, sf_dir))
    return summary.withColumn("columns_sample", F.array_join("columns_sample", ","))


# -- models ---------------------------------------------------------------------------------


#: The published settings, the defaults of the plans.
FOREST = ForestSettings()


#: Splits by the telling feature alone are best in every tree, whatever rows it draws.
STATUS_FOREST = ForestSettings(n_trees=5, max_depth=3, feature_subset="all")


def prepared(spark, sf_dir):
    # training fits read the merged table several times
    return training_table(cut_lineage(mixed(spark, sf_dir)), b.y(spark, sf_dir), b.y_supp(spark, sf_dir))


@query("rf_weighted")
def rf_weighted(spark, sf_dir):
    table, features, _ = prepared(spark, sf_dir)
    model = fit_forest(weights.add_margin_weight(table, "exp", cap=5.0), features, FOREST)
    return evaluate.top_features(importance_table(model, spark), 30)


@query("rf_grid_cv")
def rf_grid_cv(spark, sf_dir):
    table, features, _ = prepared(spark, sf_dir)
    weighted = weights.add_margin_weight(table, "none")
    return grid_search(weighted, features, FOREST_GRID, base=FOREST).frame(spark)


@query("weighting_scenarios")
def weighting_scenario_ranking(spark, sf_dir):
    table, features, _ = prepared(spark, sf_dir)
    return weighting_scenarios(table, features, grid=FOREST_GRID, base=FOREST)[0]


@query("gbt_ovr")
def gbt_ovr(spark, sf_dir):
    table, features, _ = prepared(spark, sf_dir)
    return boosted_run(table, features, settings=HISTOGRAM_BOOST, tune_draw=True).accuracies


@query("gbt_tuned")
def gbt_tuned(spark, sf_dir):
    """The tuned parameter set: patience on the validation part, penalties on the leaves."""
    table, features, _ = prepared(spark, sf_dir)
    return boosted_run(table, features, settings=TUNED_BOOST, select=False, tune_draw=True, permute_top=0).accuracies


def status_rows(spark, sf_dir):
    """Labelled orders with a feature that tells the class, and two that don't: the best tree is known."""
    orders = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"), "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"),
        F.when(F.col("o_orderstatus") == "F", 2.0).when(F.col("o_orderstatus") == "O", 7.5).otherwise(5.0).alias("status_code"),
    )
    features = ["o_totalprice", "status_code", "o_custkey"]
    return shared_rows(b.labelled(spark, sf_dir).join(orders, "ID"), features, ["ID"]), features


def rounded_shares(scored):
    shares = [F.round(c, 9).alias(c) for c in evaluate.PROBABILITIES]
    return scored.select("ID", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), *shares)


@query("forest_of_status")
def forest_of_status(spark, sf_dir):
    rows, features = status_rows(spark, sf_dir)
    return rounded_shares(fit_forest(rows, features, STATUS_FOREST, weight=None).score(rows))


@query("forest_of_status_importance")
def forest_of_status_importance(spark, sf_dir):
    rows, features = status_rows(spark, sf_dir)
    shares = evaluate.top_features(importance_table(fit_forest(rows, features, STATUS_FOREST, weight=None), spark), 3)
    return shares.select("feature", F.round("importance", 9).alias("importance"))


@query("grid_of_status")
def grid_of_status(spark, sf_dir):
    """Cross-validated accuracy where it is known: two splits tell all classes, and deeper forests add none."""
    rows, features = status_rows(spark, sf_dir)
    folded = rows.withColumn("fold", (F.col("ID") % 3).cast("string"))
    grid = {"n_trees": (1, 3), "max_depth": (2, None), "min_split": (2, 10)}
    found = grid_search(folded, features, grid, base=STATUS_FOREST, weight=None, fold="fold")
    return found.frame(spark).select("params", F.round("cv_accuracy", 9).alias("cv_accuracy"))


@query("gbt_of_status")
def gbt_of_status(spark, sf_dir):
    rows, features = status_rows(spark, sf_dir)
    model = fit_boosted(rows, features, BoostSettings(rounds=3, max_depth=2, learning_rate=0.5), weight=None)
    return model.score(rows).select("ID", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


@query("permutation_importance")
def permutation_top(spark, sf_dir):
    table, features, _ = prepared(spark, sf_dir)
    split = StratifiedSplit.fit(table, VALID_20)
    model = fit_forest(weights.add_margin_weight(split.select(table, "train"), "none"), features, FOREST)
    return permutation_importance(model, split.select(table, "valid"))


@query("batch_score")
def batch_score(spark, sf_dir):
    merged = cut_lineage(mixed(spark, sf_dir))
    train = merged.join(b.train_ids(spark, sf_dir), "ID", "left_semi")
    test = merged.join(b.test_ids(spark, sf_dir), "ID", "left_semi")
    table, features, levels = training_table(train, b.y(spark, sf_dir))
    model = fit_forest(weights.add_margin_weight(table, "none"), features, FOREST)
    folder = Artifact(model, categories=levels).save(spark, scratch_path(spark, "model"))
    return predict(test, Artifact.load(spark, folder), as_probabilities=True)


@query("batch_score_totals")
def batch_score_totals(spark, sf_dir):
    sums = F.col("HOME_WINS") + F.col("DRAW") + F.col("AWAY_WINS")
    return batch_score(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("ID").alias("n_ids"),
        F.count_if(F.abs(sums - 1) > 1e-9).alias("bad_sums"),
    )


@query("run_report")
def model_report(spark, sf_dir):
    table, features, _ = prepared(spark, sf_dir)
    model = fit_forest(weights.add_margin_weight(table, "none"), features, FOREST)
    report = run_report(model.score(table), model, len(features))
    return report.select("n_rows", "accuracy", "n_features", F.inline("report"))


@query("run_report_totals")
def model_report_totals(spark, sf_dir):
    """What the tables alone decide of a run's report: sizes, features and support per class."""
    return model_report(spark, sf_dir).select("class_name", "support", "n_rows", "n_features")


@query("rf_importance_totals")
def rf_importance_totals(spark, sf_dir):
    """The exact feature list with its places; importances are shares of 1."""
    table, features, _ = prepared(spark, sf_dir)
    model = fit_forest(weights.add_margin_weight(table, "linear"), features, FOREST)
    whole = Window.partitionBy(F.lit(0))
    shares = importance_table(model, spark).withColumn("total", F.round(F.sum("importance").over(whole), 6))
    return shares.select("position", "feature", "total", F.col("importance").between(0.0, 1.0).alias("is_share"))


@query("gbt_ovr_sizes")
def gbt_ovr_sizes(spark, sf_dir):
    """Rows per split of the boosted run; each is scored once and all have an accuracy."""
    return gbt_ovr(spark, sf_dir).select("split", "n_rows", F.col("accuracy").between(0.0, 1.0).alias("has_accuracy"))
