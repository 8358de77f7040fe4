import random

import corpus_pipeline
from llm.test_byte_cnn import text
from llm.test_simhash_pivots import brute_print, brute_roots

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(11)
    rows = []
    for i in range(160):
        lang = rng.choice(["aa", "bb", "cc"])
        rows.append([i, text(rng, lang, rng.choice([20, 150, 900])), lang, rng.choice(["s1", "s2", None]), 0])
    for i in range(160, 200):  # exact copies and copies with an edited word
        row = list(rng.choice(rows[:40]))
        words = row[1].split(" ")
        if i % 2:
            words[len(words) // 2] = "edited"
        rows.append([i, " ".join(words), *row[2:]])
    rows += [[300, None, "aa", "s1", 0], [301, "", None, "s1", 0], [302, "12 34", "bb", None, 0]]
    return rows


def test_stages_equal_brute_force(spark, tmp_path):
    rows = documents()
    path = f"{tmp_path}/sf/documents.parquet"
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    docs, seen = spark.read.parquet(path), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, f"{tmp_path}/sf").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    named, exact, near, mix, pieces = seen
    ids = lambda got: sorted(r.doc_id for r in got)
    assert ids(named) == [r[0] for r in rows if r[0] < 300]
    largest = {}
    for r in named:
        largest[r.text] = max(largest.get(r.text, -1), r.doc_id)
    assert ids(exact) == sorted(largest.values())
    ordered = sorted(exact, key=lambda r: r.doc_id)
    roots = brute_roots([brute_print(r.text) for r in ordered])
    assert ids(near) == sorted({ordered[k].doc_id for k in roots}) and len(near) < len(exact)
    assert set(ids(mix)) <= set(ids(near)) and max(ids(mix).count(i) for i in ids(mix)) <= 3
    assert abs(sum(len(r.text.split()) for r in mix) / sum(len(r.text.split()) for r in near) - 1) < 0.1
    assert set(r.doc_id for r in pieces) == set(ids(mix))
    for i in set(ids(mix)):
        mine = [r for r in pieces if r.doc_id == i]
        assert sum(r.length for r in mine) == ids(mix).count(i) * mine[0].doc_tokens
    assert corpus_pipeline.run(spark, f"{tmp_path}/sf").count() > 0
    odd = spark.createDataFrame([[*r, "a", 1.5, "x"] for r in rows[:30]] + [[None] * 8], SCHEMA + ", keep_id string, score double, copies string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, "unused")
        assert out.columns == odd.columns and {(r.keep_id, r.score, r.copies) for r in out.where("doc_id IS NOT NULL").collect()} == {("a", 1.5, "x")}
    # Every working name that a stage uses or used, names that need quotes, and types without an order, with repeated rows.
    names = ("__text", "text_", "__copy", "__score", "__lang_pred", "__body", "__digest", "__of", "__row", "__id", "__key", "__g_id", "__g_check",
             "__m_id", "__m_copies", "__place", "__host", "c0", "c1", "a.b", "a`b", "lang_pred", "draw", "fp", "size")
    schema = SCHEMA + "".join(f", `{n.replace('`', '``')}` string" for n in names) + ", kept map<string,int>"
    clash = spark.createDataFrame([[*r, *names, {"k": i % 2}] for i, r in enumerate([*rows[:30], *rows[:6], *rows[:6]])], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, clash, "unused")
        assert got.columns == clash.columns
        seen = got.collect()
        assert seen and all(tuple(r)[5:-1] == names and r[-1] in ({"k": 0}, {"k": 1}) for r in seen)
        if "dedup" in name:
            assert len({r.doc_id for r in seen}) == len(seen) == len({r.text for r in seen})
    assert corpus_pipeline.STAGES[-1][1](spark, clash, "unused").count() >= 42
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "unused").count() == 0
