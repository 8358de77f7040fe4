import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchspark.operators import joins
from matchspark.sources.bucketed import buckets_for, open_bucketed, write_bucketed


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def tables(spark):
    x = spark.range(500).selectExpr("id AS ID", "id * 2 AS `x y`").unionAll(spark.createDataFrame([(None, 5)], "ID long, x long"))
    y = spark.range(0, 600, 2).selectExpr("id AS ID", "id % 3 AS HOME_WINS", "1 AS DRAW")
    supp = spark.range(0, 600, 5).selectExpr("id AS ID", "cast(id AS double) AS GOAL_DIFF_HOME_AWAY")
    return x, y, supp


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_labels_join_without_an_exchange(spark, tmp_path, no_broadcast):
    made = tables(spark)
    kept = [spark.table(write_bucketed(df, str(tmp_path / f"t{i}"), buckets=8)) for i, df in enumerate(made)]
    plain, bucketed = joins.analysis_table(*made), joins.analysis_table(*kept)
    assert exchanges(plain) > 0 and exchanges(bucketed) == 0
    assert rows(bucketed) == rows(plain)
    grouped = kept[0].groupBy("ID").agg(F.sum("`x y`").alias("s"))
    assert exchanges(grouped) == 0 and grouped.count() == 501
    assert exchanges(joins.keep_known_ids(kept[1], kept[0])) == 0


def test_tables_are_opened_in_another_session(spark, tmp_path, no_broadcast):
    x, y, _ = tables(spark)
    for i, df in enumerate((x, y)):
        write_bucketed(df, str(tmp_path / f"it's {i}"), buckets=4)
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    opened = [open_bucketed(other, str(tmp_path / f"it's {i}"), df.schema, "ID", 4) for i, df in enumerate((x, y))]
    joined = joins.labelled_features(opened[1], opened[0])
    assert exchanges(joined) == 0
    assert rows(joined) == rows(joins.labelled_features(y, x))
    assert len(list((tmp_path / "it's 0").glob("part-*.parquet"))) == 4


def test_bucket_number_is_a_power_of_two_with_work_for_all_cores(spark):
    n = buckets_for(spark.range(10))
    assert n & (n - 1) == 0 and n >= spark.sparkContext.defaultParallelism
