import math
import random
import re

import pytest

from conftest import rows
from matchspark.llm.entropy_mix import mix_copies, mixed

SCHEMA = "doc_id long, text string, source string, size string, m_size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Give out by weight; who is over the limit stops there; repeat with the rest."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    got, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return got | {s: weight[s] * level for s in open_}
        for s in over:
            got[s] = most * sizes[s]
            left -= got[s]
        open_ -= over
    return got


def corpus(seed, n=400):
    rng = random.Random(seed)
    sources = ["a", "b", "c", "B", "é", None, "zz"]
    docs = []
    for i in range(n):
        k = 7 if rng.random() < 0.3 else int(rng.lognormvariate(3, 1.2))
        s = "a" if rng.random() < 0.4 else rng.choice(sources)
        docs.append((i, "\x0b\t".join(["w\u00a0x"] * k), s, None, None))
    return docs


@pytest.mark.parametrize("seed", [1])
def test_targets_rates_and_limits(spark, seed):
    docs = corpus(seed)
    got = mix_copies(spark.createDataFrame(docs, SCHEMA)).collect()
    sizes, size_of, source_of = {}, {}, {}
    for i, t, s, _, _ in docs:
        size_of[i], source_of[i] = len(WORD.findall(t)), s
        sizes[s] = sizes.get(s, 0) + size_of[i]
    want = brute_targets(sizes)
    assert len(got) == len(docs) and {r.doc_id for r in got} == set(size_of)
    for r in got:
        s = source_of[r.doc_id]
        assert (r["size"], r.source_size) == (size_of[r.doc_id], sizes[s])
        assert math.isclose(r.target, want[s], rel_tol=1e-9)
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
    for s in sizes:
        longest = max(r["size"] for r in got if source_of[r.doc_id] == s)
        assert abs(sum(r.taken for r in got if source_of[r.doc_id] == s) - want[s]) <= 2 * longest
    again = mix_copies(spark.createDataFrame(docs[::-1], SCHEMA).repartition(5))
    assert rows(again) == sorted(tuple(r) for r in got)


def test_ranges_of_one_hot_class_add_up(spark, monkeypatch):
    monkeypatch.setattr("matchspark.llm.entropy_mix.RANKED", 10)
    docs = [(i, "one two", "a", None, None) for i in range(500)] + [(500 + i, "one two three", "b", None, None) for i in range(300)]
    got = mix_copies(spark.createDataFrame(docs, SCHEMA)).collect()
    for s in (range(500), range(500, 800)):
        assert abs(sum(r.taken for r in got if r.doc_id in s) - next(r.target for r in got if r.doc_id in s)) <= 6


def test_edges(spark):
    docs = [(1, None, "a", None, None), (2, "", None, None, None), (None, " \n", "a", None, None)]
    assert rows(mix_copies(spark.createDataFrame(docs, SCHEMA)), "doc_id", "size", "target", "copies", "taken") == [
        (None, 0, 0.0, 1, 0), (1, 0, 0.0, 1, 0), (2, 0, 0.0, 1, 0),
    ]
    assert mix_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixed(spark.createDataFrame([], SCHEMA)).count() == 0
    one = mix_copies(spark.createDataFrame([(1, "a b c", "s", None, None)], SCHEMA)).first()
    assert (one.target, one.taken) == (3.0, 3)


def test_mixed_repeats_rows(spark):
    docs = corpus(3, 150) + [(7_000, "same words here", "b", "s", "c")] * 4
    df = spark.createDataFrame(docs, SCHEMA)
    copies = {}
    for r in mix_copies(df).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    out = mixed(df)
    assert out.columns == df.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}
