"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Every source gets a target number of words. Among all document rates between 0 and ``most`` that meet
the target, entropy balancing picks the ones closest to 1 in relative entropy; they have the form
``min(most, exp(t * size / m))`` with one tilt ``t`` per source (``m``: its word-weighted mean size). The
tilts maximise a concave dual; Newton steps solve it for all sources at once, each step one aggregate
over (source, size) counts. A bracket around every tilt holds steps that would leave it.

Rates become copies by walking a source's documents in order of size and taking the whole part of the
running sum of rates: the words taken differ from the target by less than two of its longest documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchspark.llm.common import WORD, Numbered
from matchspark.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
#: Documents of one source and size that are ranked by one task, about.
RANKED = 2000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """Targets of (source, source_size): shares of all words by weight, none above ``most`` times its size.

    Sources are weighted in code point order, null last, the weights repeating. What a source cannot take
    goes to the others by weight, until none is above its limit. One row per source comes in, already
    summed, and the rows are ranked together.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    limits = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    # The sources that stop at their limit are the first ones in order of limit per weight.
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.greatest(left, F.lit(0.0)) / open_weight
    tried = limits.withColumn("level", level).withColumn("fits", F.col("level") <= F.col("limit") / F.col("weight"))
    first = F.min(F.when(F.col("fits"), F.struct(F.col("limit") / F.col("weight"), F.col("rank"), F.col("level")))).over(everything)
    chosen = tried.withColumn("chosen", first["level"])
    return chosen.select("source", "source_size", F.least(F.col("limit"), F.col("weight") * F.col("chosen")).alias("target"))


def tilts(counts: DataFrame, targets: DataFrame, most: float = 3.0, close: float = 1e-7, steps: int = 80) -> DataFrame:
    """Tilt and mean size of every source with words: Newton steps on the dual, until all are ``close``.

    ``counts`` has source, size (above 0) and n. Each step is written to the shared folder, so neither its
    plan nor a repeated task reaches back to earlier ones.
    """
    w = F.col("n") * F.col("size")
    of = counts.groupBy("source").agg(
        F.sum(w).cast("double").alias("total"), (F.sum(w * F.col("size")) / F.sum(w)).alias("mean"), F.min("size").alias("least")
    )
    goal = targets.select(F.col("source").alias("t_source"), "target")
    state = of.join(goal, F.col("source").eqNullSafe(F.col("t_source")), "inner")
    smallest, ratio = F.col("least") / F.col("mean"), F.col("target") / F.col("total")
    state = cut_lineage(
        state.select(
            "source", "mean", "target", F.lit(0.0).alias("tilt"),
            F.when(ratio < 1, F.log(F.greatest(ratio, F.lit(1e-300))) / smallest).otherwise(0.0).alias("low"),
            F.when(ratio > 1, F.log(F.lit(float(most))) / smallest).otherwise(0.0).alias("high"),
        )
    )
    for _ in range(steps):
        s = state.select(F.col("source").alias("s_source"), "mean", "target", "tilt", "low", "high")
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(700.0)))
        open_rate = F.when(rate < most, rate * x).otherwise(0.0)
        moved = (
            counts.join(s, F.col("source").eqNullSafe(F.col("s_source")))
            .groupBy("source", "mean", "target", "tilt", "low", "high")
            .agg(F.sum(w * F.least(rate, F.lit(float(most)))).alias("got"), F.sum(w * open_rate).alias("slope"))
        )
        off = (F.log("got") - F.log("target")) * F.col("got")
        low = F.when(F.col("got") <= F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("got") >= F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        newton = F.when((F.col("got") > 0) & (F.col("slope") > 0), F.col("tilt") - off / F.col("slope"))
        moved = moved.withColumns({"low": low, "high": high, "step": newton})
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        error = F.when(F.col("target") > 0, F.abs(F.col("got") - F.col("target")) / F.col("target")).otherwise(F.col("got"))
        done = (error <= close) | (F.col("low") >= F.col("high"))
        moved = moved.withColumn("error", F.when(done, 0.0).otherwise(error)).withColumn(
            "tilt", F.when(done, F.col("tilt")).when(inside, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
        )
        state = cut_lineage(moved.select("source", "mean", "target", "tilt", "low", "high", "error"))
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= close:
            break
    return state.select("source", "mean", "tilt")


def mix_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = 3,
) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of every row of ``docs``.

    Size is the number of words, 0 for a null or empty text. A document without words has one copy and
    takes nothing. Null sources are one source, the last. Which documents of one source and size get the
    odd copy is decided by a hash of the id, so reruns agree; equal ids are ordered arbitrarily among
    themselves. Extra columns are left out. If no document has words, all targets are 0. An empty table
    gives an empty result.

    No step brings a source together in one task: sums are combined before the shuffle, and documents of one
    source and size are ranked in hash ranges of about ``RANKED`` rows with offsets from counts per range.
    """
    sizes = cut_lineage(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"))
    )
    counts = cut_lineage(sizes.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = cut_lineage(source_targets(sources, weights, float(most)))
    tilt = tilts(counts.where("size > 0"), targets, float(most)).select(F.col("source").alias("k_source"), "mean", "tilt")
    goal = targets.select(F.col("source").alias("t_source"), "source_size", "target")

    rate = F.least(F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(700.0))), F.lit(float(most)))
    in_source = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.when(F.col("size") > 0, F.col("n") * F.col("rate")).otherwise(0.0)).over(in_source)
    classes = (
        counts.join(goal, F.col("source").eqNullSafe(F.col("t_source")))
        .join(tilt, F.col("source").eqNullSafe(F.col("k_source")), "left")
        .withColumn("rate", F.when(F.col("target") > 0, F.coalesce(rate, F.lit(1.0))).otherwise(0.0))
        .withColumn("end", end)
        .withColumn("start", F.lag("end", 1, 0.0).over(Window.partitionBy("source").orderBy("size")))
        .withColumn("all_copies", (F.floor(F.col("end") + 0.5) - F.floor(F.col("start") + 0.5)).cast("long"))
        .select(
            F.col("source").alias("c_source"), F.col("size").alias("c_size"), "n", "source_size", "target",
            F.when(F.col("size") > 0, F.floor(F.col("all_copies") / F.col("n"))).otherwise(1).cast("long").alias("base"),
            F.when(F.col("size") > 0, F.col("all_copies") % F.col("n")).otherwise(0).cast("long").alias("odd"),
            F.ceil(F.col("n") / F.lit(RANKED)).cast("long").alias("ranges"),
        )
    )
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    placed = (
        sizes.join(cut_lineage(classes), F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")))
        .withColumn("draw", draw)
        .withColumn("range", F.floor(F.col("draw") * F.col("ranges")).cast("long"))
    )
    # Only classes with several ranges need offsets; the others start at 0.
    key = ["source", "size", "range"]
    below = Window.partitionBy("source", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.where("ranges > 1").groupBy(*key).agg(F.count("*").alias("m"))
        .withColumn("offset", F.coalesce(F.sum("m").over(below), F.lit(0)))
        .select(F.col("source").alias("o_source"), F.col("size").alias("o_size"), F.col("range").alias("o_range"), "offset")
    )
    same = F.col("source").eqNullSafe(F.col("o_source")) & (F.col("size") == F.col("o_size")) & (F.col("range") == F.col("o_range"))
    ranked = placed.join(offsets, same, "left").withColumn(
        "rank", F.coalesce("offset", F.lit(0)) + F.row_number().over(Window.partitionBy(*key).orderBy("draw", "doc_id"))
    )
    copies = F.least(F.col("base") + (F.col("rank") <= F.col("odd")).cast("long"), F.lit(most).cast("long"))
    return ranked.withColumn("copies", copies).select(
        F.col("doc_id").alias(doc_id), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: every row as often as it has copies, with the columns of ``docs``, whatever their names.

    Rows that repeat id and size share their copies out by a hash of source and text, in hash ranges of about ``RANKED`` rows.
    """
    rows = Numbered(docs)
    return rows.back(_mixed(rows.df, rows[doc_id], rows[text], rows[source], **options))


def _mixed(docs: DataFrame, doc_id: str, text: str, source: str, **options) -> DataFrame:
    copies = mix_copies(docs, doc_id, text, source, **options)
    # Copies are looked up by id and size; only rows that repeat both have to share them out by place.
    per_id = cut_lineage(
        copies.groupBy(F.col(f"`{doc_id}`").alias("__m_id"), F.col("size").alias("__m_size")).agg(
            F.sum("copies").alias("__m_copies"), F.count("*").alias("__m_rows")
        )
    )
    size = word_count(F.col(f"`{text}`"))
    joined = docs.join(per_id, F.col(f"`{doc_id}`").eqNullSafe(F.col("__m_id")) & (size == F.col("__m_size")))
    times = F.col("__m_copies")
    if not per_id.where("__m_rows > 1").isEmpty():
        whole = 1 << 40
        draw = F.pmod(F.xxhash64(F.col(source), F.col(text)), F.lit(whole))
        ranges = F.ceil(F.col("__m_rows") / F.lit(RANKED))
        joined = joined.withColumn("__draw", draw).withColumn("__range", F.floor(F.col("__draw") / F.lit(float(whole)) * ranges).cast("long"))
        before = F.lit(0)
        if not per_id.where(F.col("__m_rows") > RANKED).isEmpty():
            # Only ids and sizes with several ranges need offsets; the others start at 0.
            below = Window.partitionBy("__o_id", "__o_size").orderBy("__o_range").rowsBetween(Window.unboundedPreceding, -1)
            counted = joined.where(F.col("__m_rows") > RANKED).groupBy(
                F.col("__m_id").alias("__o_id"), F.col("__m_size").alias("__o_size"), F.col("__range").alias("__o_range")
            ).agg(F.count("*").alias("m"))
            offsets = counted.withColumn("__before", F.sum("m").over(below)).drop("m")
            same = F.col("__m_id").eqNullSafe(F.col("__o_id")) & (F.col("__m_size") == F.col("__o_size")) & (F.col("__range") == F.col("__o_range"))
            joined = joined.join(offsets, same, "left")
            before = F.coalesce("__before", F.lit(0))
        place = Window.partitionBy("__m_id", "__m_size", "__range").orderBy("__draw")
        joined = joined.withColumn("__place", F.row_number().over(place) + before)
        upto = lambda k: F.floor(k * F.col("__m_copies") / F.col("__m_rows"))
        times = upto(F.col("__place")) - upto(F.col("__place") - 1)
    repeated = F.explode(F.array_repeat(F.lit(1), times.cast("int")))
    return joined.withColumn("__copy", repeated)
