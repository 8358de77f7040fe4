"""Exact duplicates, combined so that no group of copies meets in one task.

1. Each task folds its own rows with equal (digest, text).
2. The folded rows meet by (digest, salt, text); the salt comes from the row id, so a group that is
   spread over all tasks is merged in many places.
3. The winners of the salts, a bounded number per text, meet by (digest, text).

Every stage groups by the whole text besides its digest, so a clash of digests joins nothing. Only
numbers are kept per group, so each stage is a hash aggregate that starts with a map-side step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import Numbered, largest_row
from matchspark.session import cut_lineage

RESULT = ("keep_id", "group_size", "kept", "text_sha256")
#: Salts a group of copies is merged under before the winners meet.
SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def combined(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct (digest, text) of ``rows`` (id, digest, text): keep_id and group_size."""
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    merged = (
        rows.groupBy("digest", salt.alias("salt"), "text")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return merged.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def _groups(docs: DataFrame, doc_id: str, text: str, digest, salts: int) -> tuple[DataFrame, DataFrame | None]:
    """Per digest the kept id and group size; and, only if digests clash, the same per digest and text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), digest(body).alias("digest"), body.alias("text"))
    groups = combined(rows, salts)
    per_digest = cut_lineage(
        groups.groupBy("digest").agg(
            F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        )
    )
    clashes = per_digest.where("texts > 1")
    if clashes.isEmpty():
        return per_digest, None
    return per_digest, groups.join(clashes.select("digest"), "digest", "left_semi")


def mark_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256, salts: int = SALTS, keep_text: bool = True
) -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical; a null text counts as empty. Of equal texts the row with the largest
    id stays; a null id is smaller than any other and stays only if all ids of its group are null. Rows
    that repeat both text and the largest id are all marked as kept (``drop_copies`` leaves one of them).
    Input columns with the names of results are replaced. An empty table gives an empty result.

    ``digest`` only deals rows out: texts that share one are looked up by their whole text. The text
    column is left out of the result, and of its shuffle, with ``keep_text=False``.
    """
    per_digest, clashing = _groups(docs, doc_id, text, digest, salts)
    rows = Numbered(docs)
    leave = (set(RESULT) - {doc_id.lower(), text.lower()}) | (set() if keep_text else {text.lower()})
    body = F.coalesce(F.col(rows[text]), F.lit(""))
    slim = rows.df.withColumn("__body", body)
    joined = _looked_up(slim if keep_text else slim.drop(rows[text]), per_digest, clashing, digest)
    return joined.select(
        *rows.columns(leave), F.col("__keep_id").alias("keep_id"), F.col("__group_size").alias("group_size"),
        F.col(rows[doc_id]).eqNullSafe(F.col("__keep_id")).alias("kept"), F.col("__sha").alias("text_sha256"),
    )


def _looked_up(rows: DataFrame, per_digest: DataFrame, clashing: DataFrame | None, digest) -> DataFrame:
    """``rows`` (with __body) beside __keep_id, __group_size and __sha of their text."""
    marked = {"__digest": digest(F.col("__body")), "__sha": sha256(F.col("__body"))}
    known = [F.col("digest").alias("__of"), F.col("keep_id").alias("__keep_id"), F.col("group_size").alias("__group_size")]
    if clashing is None:
        slim = rows.withColumns(marked).drop("__body")
        return slim.join(per_digest.select(*known), F.col("__digest") == F.col("__of"), "left")
    groups = per_digest.where("texts = 1").select(*known, F.lit(None).cast("string").alias("__of_text"))
    groups = groups.union(clashing.select(*known, F.col("text").alias("__of_text")))
    same = (F.col("__digest") == F.col("__of")) & (F.col("__of_text").isNull() | (F.col("__of_text") == F.col("__body")))
    return rows.withColumns(marked).join(groups, same, "left")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row of every distinct text, the one with the largest id, with all columns of ``docs``, whatever their names and types.

    Rows that repeat id and text count as one document; the one with the largest other columns stays (by its JSON if a
    column has no order), so which of them is left doesn't depend on their order.
    """
    rows = Numbered(docs)
    return rows.back(_drop_copies(rows.df, rows[doc_id], rows[text], digest, salts))


def _drop_copies(docs: DataFrame, doc_id: str, text: str, digest, salts: int) -> DataFrame:
    per_digest, clashing = _groups(docs, doc_id, text, digest, salts)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    joined = _looked_up(docs.withColumn("__body", body), per_digest, clashing, digest)
    stay = joined.where(F.col(f"`{doc_id}`").eqNullSafe(F.col("__keep_id"))).select(*docs.columns)
    ids = docs.select(F.col(f"`{doc_id}`").alias("__r_id"), sha256(body).alias("__r_sha"))
    repeated = cut_lineage(ids.groupBy("__r_id", "__r_sha").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    if repeated.isEmpty():
        return stay
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__r_id")) & (sha256(body) == F.col("__r_sha"))
    whole = largest_row(docs).alias("__row")
    once = stay.join(repeated, same, "left_semi").groupBy(F.col(f"`{doc_id}`").alias("__id"), sha256(body).alias("__key")).agg(whole)
    return stay.join(repeated, same, "left_anti").unionByName(once.select("__row.*"))
