"""Run a query and its SQL side by side and compare whole results."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences, an empty list if there are none."""
    problems = []
    names = sorted(df.columns)
    got = con.execute(sql)
    described = {d[0]: str(d[1]) for d in got.description}
    if names != sorted(described):
        return [f"columns differ: only spark {set(names) - set(described)}, only sql {set(described) - set(names)}"]
    for f in df.schema:
        want = SAME_TYPE.get(f.dataType.simpleString())
        if want and want != described[f.name]:
            problems.append(f"type of {f.name}: spark {f.dataType.simpleString()} sql {described[f.name]}")
    order = [list(described).index(n) for n in names]
    sql_rows = Counter(tuple(_plain(row[i]) for i in order) for row in got.fetchall())
    spark_rows = Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if sql_rows != spark_rows:
        a, b = spark_rows - sql_rows, sql_rows - spark_rows
        problems.append(
            f"rows: spark {sum(spark_rows.values())} sql {sum(sql_rows.values())}; "
            f"only spark {sum(a.values())} e.g. {list(a)[:2]}; only sql {sum(b.values())} e.g. {list(b)[:2]}"
        )
    return problems
