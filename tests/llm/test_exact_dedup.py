import hashlib

from pyspark.sql import functions as F

from conftest import rows
from matchspark.llm.exact_dedup import drop_copies, mark_copies

SCHEMA = "doc_id long, text string, kept string, lang string"
CLASHING = "doc_id long, text string, kept string, DIGEST string"
DOCS = [
    (1, "a", "x", "en"), (5, "a", "x", "de"), (5, "a", "y", "fr"), (3, "b", None, None), (None, "b", "z", "en"),
    (None, "only null", None, "en"), (7, None, None, "en"), (8, "", None, "en"), (9, "A", None, "en"), (9, "long" * 50_000, None, "en"),
    (4, "a", "x", "en"), (6, "c", "x", "en"), (6, "c", "x", "en"),
]


def brute(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d[1] or "", []).append(d[0])
    out = []
    for d in docs:
        ids = groups[d[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((d[0], d[1], d[3], keep, len(ids), d[0] == keep, hashlib.sha256((d[1] or "").encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def weak(text):
    return (F.length(text) % 2).cast("string")


def test_equals_brute_force_and_survives_clashing_digests(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    assert rows(mark_copies(df)) == brute(DOCS)
    assert rows(mark_copies(spark.createDataFrame(DOCS, CLASHING))) == brute(DOCS)
    assert rows(mark_copies(df, digest=weak, salts=3)) == brute(DOCS)


def test_one_row_of_every_text_stays(spark):
    for digest in (None, weak):
        got = drop_copies(spark.createDataFrame(DOCS, CLASHING), **({"digest": digest} if digest else {}))
        assert got.columns == ["doc_id", "text", "kept", "DIGEST"]
        left = sorted((r.text or "", r.doc_id, r.DIGEST) for r in got.collect())
        assert [t for t, _, _ in left] == sorted({d[1] or "" for d in DOCS})
        assert ("a", 5, "fr") in left and ("", 8, "en") in left


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mark_copies(df).count() == 0 and drop_copies(df).count() == 0
