"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. Partition counts and memory stay with the cluster.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "matchspark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use ``__`` for dots and win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SESSION_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, whatever folder they start in.

    Executors on other machines get it as usual, with ``--py-files`` or an installed package.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured, in a session of one process, is a temporary folder set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="matchspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing there is ever overwritten."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Fixed value: shuffle partitions that a fine job begins with; adaptive execution joins them up to its advisory size (64 MB).
FINE_PARTITIONS = 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def fine_partitions(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside shuffle into many partitions first, so that the memory of a task follows the advisory size and not the table.

    The session's own settings are back afterwards. It reaches what is executed inside only, not what is read lazily later.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    wanted = max(FINE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")), int(before or 0))
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    Later jobs do not repeat what led to it, read only the columns they need, and lose nothing
    with an executor.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
