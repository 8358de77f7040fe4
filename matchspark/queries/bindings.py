"""The match tables as views of the order tables, whole tables throughout.

An order is a match: its own columns are the home team's, its customer's the away team's, its
open line items the home players, its fulfilled ones the away players, its status the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspark.operators.weights import class_labels, labelled_only
from matchspark.session import scratch_path
from matchspark.sources.files import CSV_DIALECT, read_table
from matchspark.streaming.rollup import csv_player_stream, player_stream

TEST_FROM = "2000-01-01"
OVERLAP_FROM = "1999-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def home_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"), "o_totalprice", "o_custkey", "o_orderpriority"
    )


def away_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    return orders.join(customers, "c_custkey").select("ID", "c_acctbal", "c_nationkey", "c_mktsegment")


def player_rows(items: DataFrame, status: str | None = None) -> DataFrame:
    """Line items, of one status or all, in whole cents and percents, so that their sums are exact in any order.

    A returned line has no known quantity, a discount of 0 is no known discount.
    """
    wanted = items if status is None else items.where(F.col("l_linestatus") == status)
    return wanted.select(
        F.col("l_orderkey").alias("ID"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("l_quantity"),
        F.round(F.col("l_extendedprice") * 100).alias("l_extendedprice"),
        F.nullif(F.round(F.col("l_discount") * 100), F.lit(0.0)).alias("l_discount"),
        F.round(F.col("l_tax") * 100).alias("l_tax"),
    )


def players(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    return player_rows(table(spark, sf_dir, "lineitem"), status)


def arriving(spark: SparkSession, rows: DataFrame, batches: int, fmt: str = "parquet") -> tuple[str, int]:
    """Folder of ``rows`` in as many files as the session has partitions, and files per micro-batch for ``batches`` of them.

    Each of at least ``batches`` files takes the same share of the rows, and the work of a task doesn't grow with the table
    where the partitions do.
    """
    folder = scratch_path(spark, "arriving")
    files = -(-max(batches, int(spark.conf.get("spark.sql.shuffle.partitions"))) // batches) * batches
    writer = rows.repartition(files).write
    (writer.options(**CSV_DIALECT) if fmt == "csv" else writer).format(fmt).save(folder)
    return folder, files // batches


def player_file_stream(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """All player rows as a stream of ``batches`` micro-batches; a match's players come in different ones."""
    items = table(spark, sf_dir, "lineitem")
    folder, files = arriving(spark, items, batches)
    return player_rows(player_stream(spark, folder, items.schema, files_per_batch=files))


PLAYER_TYPES = T.StructType([
    T.StructField("ID", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
])


def player_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All player rows as a CSV writer might leave them: missing texts of several kinds, decimals only in some
    rows, blanks around numbers, a column that isn't wanted, and a tax that is no number on every seventh line of an order."""
    items = table(spark, sf_dir, "lineitem")
    seventh = F.col("l_linenumber") == 7
    return items.select(
        F.col("l_orderkey").alias("ID"),
        F.when(F.col("l_returnflag") == "R", F.when(F.col("l_linenumber") % 2 == 0, "NA").otherwise("")).otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.lit("not wanted, a comment").alias("comment"),
        F.concat(F.lit(" "), F.round(F.col("l_extendedprice") * 100).cast("long").cast("string")).alias("l_extendedprice"),
        F.when(F.round(F.col("l_discount") * 100) == 0, "N/A").otherwise(F.round(F.col("l_discount") * 100).cast("string")).alias("l_discount"),
        F.when(seventh, "unknown").otherwise(F.round(F.col("l_tax") * 100).cast("string")).alias("l_tax"),
    )


def player_csv_stream(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """The same as a stream of CSV files."""
    texts = player_texts(spark, sf_dir)
    folder, files = arriving(spark, texts, batches, "csv")
    return csv_player_stream(spark, folder, texts.columns, PLAYER_TYPES, files)


def vector_stream(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """The vectors as a stream of ``batches`` micro-batches."""
    wide, names = vectors(spark, sf_dir)
    rows = wide.select(F.col("label").alias("ID"), *names)
    folder, files = arriving(spark, rows, batches)
    return player_stream(spark, folder, rows.schema, files_per_batch=files)


def vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The vectors as one column per place, and the places' names. All vectors must have one length."""
    rows = table(spark, sf_dir, "embeddings")
    shortest, longest = rows.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if shortest != longest:
        raise ValueError(f"vectors have {shortest} to {longest} places")
    names = [f"e{i}" for i in range(longest or 0)]
    places = [f"CAST(get(embedding, {i}) AS double) AS {c}" for i, c in enumerate(names)]
    return rows.selectExpr("vec_id", "label", *places), names


def home_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players(spark, sf_dir, "O")


def away_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players(spark, sf_dir, "F")


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return tuple(make(spark, sf_dir) for make in (home_team, away_team, home_player, away_player))


def y(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot result of every order; it is unknown where the priority is unspecified."""
    status = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"),
        (status == "F").cast("int").alias("HOME_WINS"),
        (status == "O").cast("int").alias("DRAW"),
        (status == "P").cast("int").alias("AWAY_WINS"),
    )


def y_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open minus fulfilled line items; orders without line items have no row."""
    goal = F.when(F.col("l_linestatus") == "O", 1.0).otherwise(-1.0)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("ID"))
        .agg(F.sum(goal).alias("GOAL_DIFF_HOME_AWAY"))
    )


def train_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderdate") < F.lit(TEST_FROM)).select(F.col("o_orderkey").alias("ID"))


def test_ids(spark: SparkSession, sf_dir: str, start: str = TEST_FROM) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderdate") >= F.lit(start)).select(F.col("o_orderkey").alias("ID"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_only(class_labels(y(spark, sf_dir)))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ID, label and three probabilities, a fixed function of the ordered quantity, 0 without line items."""
    q = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("ID"))
        .agg(F.sum("l_quantity").alias("q"))
    )
    a = F.lit(100.0) - F.least(F.col("q"), F.lit(99.0))
    total = F.col("q") + F.lit(52.0) + a
    return labelled(spark, sf_dir).join(q, "ID", "left").na.fill(0.0, ["q"]).select(
        "ID", "label", (F.col("q") / total).alias("p_home"), (F.lit(52.0) / total).alias("p_draw"), (a / total).alias("p_away")
    )


def repeated_orders(spark: SparkSession, sf_dir: str, price_step: float) -> DataFrame:
    """All orders, those of status P twice; the copy differs by ``price_step``."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ID"), "o_totalprice", "o_orderstatus", "o_orderpriority")
    copies = orders.where(F.col("o_orderstatus") == "P")
    if price_step:
        copies = copies.withColumn("o_totalprice", F.col("o_totalprice") + F.lit(price_step))
    return orders.unionByName(copies)
