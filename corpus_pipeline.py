"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, whole, and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchspark.llm.bm25_pack import packed
from matchspark.llm.byte_cnn import UNKNOWN, confidence_limit, predict_languages, train_languages
from matchspark.llm.common import Numbered, fold
from matchspark.llm.entropy_mix import mixed
from matchspark.llm.exact_dedup import drop_copies
from matchspark.llm.simhash_pivots import drop_near_copies
from matchspark.session import cut_lineage


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised, with all columns of ``docs``, whatever their names.

    Texts that are missing or hold no letter go, and those whose language the net names with less certainty than it has for
    999 of 1000 labelled documents that it hasn't learned from and names rightly (see ``confidence_limit``).
    """
    rows = Numbered(docs)
    doc_id, text, lang = (rows[c] for c in ("doc_id", "text", "lang"))
    net = train_languages(rows.df, rows.df.select(doc_id, lang).where(fold(doc_id, 4) != 2), doc_id=doc_id, text=text, label=lang)
    held = rows.df.where((fold(doc_id, 4) == 2) & F.col(lang).isNotNull()).select(text, lang)
    limit = confidence_limit(predict_languages(held, net, text=text, keep_text=False), lang)
    named = predict_languages(rows.df, net, text=text)
    return rows.back(named.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= limit)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text, the one with the largest id."""
    return drop_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked fingerprints, the one with the smallest id.

    Reach and shingles are those of the operator's query: 2 bits over 3-word shingles. That finds copies with a few edited
    words in long texts and leaves most looser ones; see the README for the measured share.
    """
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times each."""
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_duplicates),
    ("entropy_mix", mix_sources),
    ("bm25_packing", pack_sequences),
]

#: SQL has no counterpart of the trained network, the near-duplicate groups and the packing; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
