"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.session import cut_lineage


def _star(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest of u and everything u is paired with; a hot u is combined before the shuffle."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
    return pairs.join(least, F.col("u") == F.col("of"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the root is the smallest node it is linked with.

    A round links the larger neighbours of a node to its smallest one (large star), then a node and its
    smaller neighbours (small star). When nothing changes, every node hangs on its root. Each round
    is written to the shared folder. Edges from a node to itself are ignored.
    """
    now = cut_lineage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )
    mark = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        starred = _star(large)
        small = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).union(starred.select("u", F.col("m").alias("v")))
        now = cut_lineage(small.where("u <> v").distinct())
        # Rows are distinct: equal counts and sums of hashes mean that the round changed nothing.
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
