"""Player roll-up over arriving files. Its result equals the batch roll-up's."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchspark.functions.text import named, project, tick
from matchspark.operators.columns import numeric_columns, quoted
from matchspark.operators.rollup import CHUNK_SIZE, assemble_chunks, chunks, fold_chunks, roll_up
from matchspark.session import SESSION_SETTINGS
from matchspark.sources.files import CSV_DIALECT, checked_texts

STATE_KEYS = ("_key", "_pos")
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def player_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Files of a folder as they arrive, with a given schema, at most so many per micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


MISFITS = "misfits"


def csv_player_stream(
    spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """CSV files of a folder as they arrive, typed like ``read_csv``: the columns of ``schema``, of files with ``columns``.

    Cells are read as texts, so that missing texts are known before they are typed; a text that doesn't fit becomes NULL
    and is counted where the stream reads it (``stream_misfits``). Every column keeps the type given here, so a column of
    whole numbers in which decimals come late should be a double from the start.
    """
    texts = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.readStream.schema(texts).options(**CSV_DIALECT).format("csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    checked, flags = checked_texts(reader.load(path), schema)
    counted = [F.count_if(F.expr(flag)).alias(c) for c, flag in flags.items()]
    return project(checked.observe(MISFITS, F.count(F.lit(1)).alias("_rows"), *counted), schema.names)


def stream_misfits(query: StreamingQuery) -> dict[str, int]:
    """Rows (``_rows``) and misfits per column of the micro-batches that ``query`` remembers."""
    total: dict[str, int] = {}
    for progress in query.recentProgress:
        seen = progress.observedMetrics.get(MISFITS)
        for name, n in (seen.asDict() if seen else {}).items():
            total[name] = total.get(name, 0) + n
    return total


def read_through(stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Read every row and column of a stream for what it counts on the way (``stream_misfits``); no state is kept and nothing is written."""
    return stream.writeStream.format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# -- state kept by the engine ---------------------------------------------------------------


def stream_rollup(players: DataFrame, out: str, checkpoint: str, key: str = "ID", **options) -> StreamingQuery:
    """Keep the roll-up in the streaming state; every micro-batch writes the keys it changed.

    A batch writes its own folder and a replayed batch replaces it, so a restart is harmless.
    """
    # one state row per key, for as long as the stream runs: it belongs on disk, not on the heap
    players.sparkSession.conf.set(STATE_STORE, SESSION_SETTINGS[STATE_STORE])
    rolled = roll_up(players, key, strategy="direct", **options)

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _run(rolled, write, checkpoint, "update")


def latest_rollup(spark: SparkSession, out: str, key: str = "ID", after: int = -1, base: str | None = None) -> DataFrame:
    """Per key what the last batch that changed it wrote. Folds on the map side.

    With ``base``, a table that ``compact_rollup`` wrote, only batches later than ``after`` are read besides it.
    """
    last = _last(spark, out, [key], after, base)
    return last.selectExpr(tick(key), "_row.*")


def _last(spark: SparkSession, out: str, keys: Sequence[str], after: int, base: str | None, upto: int | None = None) -> DataFrame:
    written = spark.read.parquet(out).where(F.col("batch") > after)
    if upto is not None:
        written = written.where(F.col("batch") <= upto)
    if base is not None:
        written = written.unionByName(spark.read.parquet(base).withColumn("batch", F.lit(after)))
    rest = [c for c in written.columns if c not in (*keys, "batch")]
    return written.groupBy(*map(tick, keys)).agg(F.expr(f"max_by(struct({', '.join(map(tick, rest))}), batch) AS _row"))


def compact_rollup(
    spark: SparkSession, out: str, upto: int, into: str, keys: Sequence[str] = ("ID",), after: int = -1, base: str | None = None
) -> str:
    """Keep of the batches in (after, upto] and ``base`` the last row per key, in a new table ``into``."""
    last = _last(spark, out, keys, after, base, upto)
    last.selectExpr(*map(tick, keys), "_row.*").write.mode("errorifexists").parquet(into)
    return into


class WideRollup:
    """The roll-up of a wide stream: what ``stream_wide_rollup`` has written, read back.

    The streaming state has a row per key and chunk of columns, so neither the generated code nor a
    state row grows with the width.
    """

    def __init__(self, spark: SparkSession, out: str, columns: Sequence[str], key: str = "ID", moments: str = "sample"):
        self.spark, self.out, self.key, self.moments = spark, out, key, moments
        self.batches = chunks(list(columns), CHUNK_SIZE)

    def rollup(self, prefix: str = "", after: int = -1, base: str | None = None) -> DataFrame:
        states = _last(self.spark, self.out, STATE_KEYS, after, base).selectExpr(*STATE_KEYS, "_row._state AS _state")
        return assemble_chunks(states, self.key, self.batches, prefix, self.moments)


def stream_wide_rollup(
    players: DataFrame, out: str, checkpoint: str, key: str = "ID", moments: str = "sample"
) -> tuple[StreamingQuery, WideRollup]:
    """Keep chunks of the roll-up in the streaming state; every micro-batch writes the chunks it changed."""
    spark = players.sparkSession
    spark.conf.set(STATE_STORE, SESSION_SETTINGS[STATE_STORE])
    wide = WideRollup(spark, out, numeric_columns(players, [key]), key, moments)
    known = players.where(quoted(key).isNotNull())

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _run(fold_chunks(known, key, wide.batches, moments), write, checkpoint, "update"), wide


# -- mergeable state in a table ---------------------------------------------------------------


def partial_moments(df: DataFrame, columns: Sequence[str], key: str = "ID") -> DataFrame:
    """Per key and chunk of columns the row count, and per column the sum and the sum of squares."""
    return fold_chunks(df.where(quoted(key).isNotNull()), key, chunks(list(columns), CHUNK_SIZE), "population_rows")


def merge_moments(state: DataFrame) -> DataFrame:
    """Add up partial states of the same key and chunk."""
    names = state.schema["_state"].dataType.names
    summed = ", ".join(named(f"sum(_state.{c})", c) for c in names)
    return state.groupBy(*STATE_KEYS).agg(F.expr(f"struct({summed}) AS _state"))


def finish_state(state: DataFrame, columns: Sequence[str], key: str = "ID", prefix: str = "") -> DataFrame:
    """sum, mean and std over all rows of the key, and the row count."""
    return assemble_chunks(state, key, chunks(list(columns), CHUNK_SIZE), prefix, "population_rows")


class MomentState:
    """Partial moments in a folder, one sub-folder per micro-batch and per compaction.

    A batch only ever writes its own sub-folder, so replaying one after a failure replaces it
    with the same rows instead of counting them twice.
    """

    def __init__(self, spark: SparkSession, folder: str, columns: Sequence[str], key: str = "ID"):
        self.spark, self.folder, self.columns, self.key = spark, folder, list(columns), key

    def add_batch(self, rows: DataFrame, batch_id: int) -> None:
        partial_moments(rows, self.columns, self.key).write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def read(self, after: int = -1, base: str | None = None) -> DataFrame:
        """Partial states of the batches later than ``after``, and of a compacted ``base``."""
        parts = [self.spark.read.parquet(self.folder).where(F.col("batch") > after).drop("batch")]
        if base is not None:
            parts.append(self.spark.read.parquet(base))
        return reduce(DataFrame.unionByName, parts)

    def compact(self, upto: int, out: str, after: int = -1, base: str | None = None) -> str:
        """Fold the batches in (after, upto] and ``base`` into a new table ``out``."""
        parts = [
            self.spark.read.parquet(self.folder)
            .where((F.col("batch") > after) & (F.col("batch") <= upto))
            .drop("batch")
        ]
        if base is not None:
            parts.append(self.spark.read.parquet(base))
        merge_moments(reduce(DataFrame.unionByName, parts)).write.mode("errorifexists").parquet(out)
        return out

    def rollup(self, prefix: str = "", after: int = -1, base: str | None = None) -> DataFrame:
        merged = merge_moments(self.read(after, base))
        return finish_state(merged, self.columns, self.key, prefix)


class TieredState(MomentState):
    """Partial moments whose batches are folded by themselves, so that a long stream is read from few tables.

    Every ``fanout`` tables of a tier are folded into one of the next. Which tables there are after a batch follows from its
    number alone: as many of each tier as the digits of that number to the base ``fanout``. Batch and
    fold write tables of their own, so a replay writes the same rows again. The number of the last finished
    batch is kept in one of two places in turn, so one of them is always whole.
    """

    def __init__(self, spark: SparkSession, folder: str, columns: Sequence[str], key: str = "ID", fanout: int = 4):
        super().__init__(spark, folder, columns, key)
        self.fanout = fanout

    def _table(self, tier: int, upto: int) -> str:
        return f"{self.folder}/tier={tier}/upto={upto}"

    def tables(self, batches: int) -> list[str]:
        """Tables that hold the first ``batches`` batches, the largest first."""
        made, tier, left = [], 0, batches
        while left:
            left, digit = divmod(left, self.fanout)
            whole = left * self.fanout ** (tier + 1)
            made += [self._table(tier, whole + (k + 1) * self.fanout**tier) for k in reversed(range(digit))]
            tier += 1
        return made[::-1]

    def add_batch(self, rows: DataFrame, batch_id: int) -> None:
        upto, tier = batch_id + 1, 0
        partial_moments(rows, self.columns, self.key).write.mode("overwrite").parquet(self._table(0, upto))
        while upto % self.fanout ** (tier + 1) == 0:
            step = self.fanout**tier
            parts = [self._table(tier, upto - k * step) for k in range(self.fanout)]
            merge_moments(self.spark.read.parquet(*parts)).write.mode("overwrite").parquet(self._table(tier + 1, upto))
            tier += 1
        done = self.spark.range(1).select(F.lit(upto).cast("long").alias("batches"))
        done.write.mode("overwrite").parquet(f"{self.folder}/finished/place={upto % 2}")

    def finished(self) -> int:
        """How many batches are whole."""
        known = 0
        for place in (0, 1):
            try:
                known = max(known, self.spark.read.parquet(f"{self.folder}/finished/place={place}").agg(F.max("batches")).first()[0] or 0)
            except AnalysisException:
                continue
        return known

    def read(self, after: int = -1, base: str | None = None) -> DataFrame:
        if after != -1 or base is not None:
            raise ValueError("tiers are folded by themselves")
        batches = self.finished()
        if not batches:
            raise ValueError("no batch has been finished")
        return self.spark.read.parquet(*self.tables(batches))

    def compact(self, upto: int, out: str, after: int = -1, base: str | None = None) -> str:
        raise ValueError("tiers are folded by themselves")


def stream_tiers(
    players: DataFrame, folder: str, checkpoint: str, key: str = "ID", fanout: int = 4
) -> tuple[StreamingQuery, TieredState]:
    """As ``stream_moments``, with tables that are folded on the way."""
    state = TieredState(players.sparkSession, folder, numeric_columns(players, [key]), key, fanout)
    return _run(players, state.add_batch, checkpoint, "append"), state


def stream_moments(players: DataFrame, folder: str, checkpoint: str, key: str = "ID") -> tuple[StreamingQuery, MomentState]:
    """Fold every micro-batch to partial moments; the stream itself keeps no state."""
    columns = numeric_columns(players, [key])
    state = MomentState(players.sparkSession, folder, columns, key)
    return _run(players, state.add_batch, checkpoint, "append"), state
