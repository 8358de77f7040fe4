"""Tables written by key, so that what joins or groups them by that key reads them without an exchange."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchspark.functions.text import tick
from matchspark.operators.columns import quoted

#: Rows a bucket should hold; a task reads a whole bucket.
ROWS_A_BUCKET = 1_000_000


def buckets_for(df: DataFrame) -> int:
    """A power of two, so that tables of unlike size can still be read together, at least one bucket per core."""
    wanted = max(df.count() / ROWS_A_BUCKET, df.sparkSession.sparkContext.defaultParallelism, 1)
    return 1 << math.ceil(math.log2(wanted))


def write_bucketed(df: DataFrame, folder: str, key: str = "ID", buckets: int | None = None, name: str | None = None) -> str:
    """Write ``df`` once, one sorted file per bucket of ``key``, and return the name under which the session knows the table.

    Tables that are to be joined need the same number of ``buckets`` and a key of the same type. All rows of one key, and all
    without one, are in one bucket: it is meant for keys of matches, not for columns with hot values.
    """
    name = name or f"matchspark_{uuid.uuid4().hex}"
    buckets = buckets or buckets_for(df)
    by_key = df.repartition(buckets, quoted(key))
    by_key.write.bucketBy(buckets, key).sortBy(key).option("path", folder).format("parquet").saveAsTable(name)
    return name


def open_bucketed(
    spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int, name: str | None = None
) -> DataFrame:
    """A table that ``write_bucketed`` wrote, made known to this session."""
    name = name or f"matchspark_{uuid.uuid4().hex}"
    columns = ", ".join(f"{tick(f.name)} {f.dataType.simpleString()}" for f in schema)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({tick(key)}) SORTED BY ({tick(key)}) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
