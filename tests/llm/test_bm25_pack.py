import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from matchspark.llm import tokens
from matchspark.llm.bm25_pack import Index, Packing, packed

SCHEMA = "doc_id long, text string, start string, ids string"


def exact(text):
    return tokens.exact_encoder().encode(text, add_special_tokens=False).ids


def test_characters_are_classed_alike():
    """Every common character between letters, digits, spaces, marks and copies of itself."""
    common = [chr(c) for c in range(0x180)] + [chr(c) for c in range(0x2010, 0x2028)]
    for c in common:
        assert tokens.is_common(c)
        text = f"a{c}a 1{c}1 {c} .{c}. {c}{c}  {c}a\n{c}1{c}\t{c}'s{c} {c}{c}{c}"
        assert tokens.encode(text).tolist() == exact(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sa1é.ß")), max_size=40))
def test_ids_equal_the_library(text):
    assert tokens.encode(text).tolist() == exact(text)


def test_special_token_and_long_runs_go_to_the_library():
    for text in ("a<|endoftext|> b", "x" * 30_000, " " * 30_000 + "a", "日本語 текст"):
        assert not tokens.is_common(text)
        assert tokens.encode(text).tolist() == exact(text)


def test_every_id_lies_in_one_piece_and_windows_are_full(spark):
    rng = random.Random(2)
    topic = [[f"w{k}x{j}" for j in range(40)] for k in range(6)]
    docs = [(i, " ".join(rng.choice(topic[i % 6]) for _ in range(rng.choice([3, 60, 300, 2500]))), "s", "i") for i in range(120)]
    docs += [(200, None, "s", "i"), (201, "", "s", "i"), (202, "z " * 40_000, "s", "i"), (None, "no id", "s", "i"), (2**62, "big id", "s", "i")]
    docs += [docs[5]] * 3
    packing = Packing(shard_tokens=60_000)
    out = packed(spark.createDataFrame(docs, SCHEMA).repartition(4), packing=packing)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got = out.collect()
    ids = {d[0]: np.array([*exact(d[1] or ""), 1], "<u4") for d in docs}
    times = {d[0]: sum(e[0] == d[0] for e in docs) for d in docs}
    covered = {k: np.zeros(len(v), int) for k, v in ids.items()}
    sequences = {}
    for r in got:
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        covered[r.doc_id][r.start : r.start + r.length] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all((c == times[k]).all() for k, c in covered.items())
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        short += at < 2048
    assert short <= -(-sum(map(len, ids.values())) // packing.shard_tokens) + 1
    assert packed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_index_ranks_like_plain_bm25():
    rng = np.random.default_rng(4)
    units = [rng.integers(0, 50, rng.integers(5, 60)).astype(np.uint16) for _ in range(40)]
    packing = Packing(query_terms=1000)
    df = np.zeros(tokens.IDS, np.int64)
    for u in units:
        df[np.unique(u)] += 1
    mean = sum(map(len, units)) / len(units)
    index = Index(units, df, len(units), mean, packing)
    free = np.ones(len(units), bool)
    free[[0, 7]] = False

    def bm25(query, unit):
        total = 0.0
        for t in set(query.tolist()):
            tf = int((unit == t).sum())
            idf = np.log(1 + (len(units) - df[t] + 0.5) / (df[t] + 0.5))
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(unit) / mean))
        return total

    scores = {i: bm25(units[0], u) for i, u in enumerate(units) if free[i]}
    got = list(index.neighbours(0, free, first=5))
    assert set(got) == {i for i, s in scores.items() if s > 0}
    ranked = [scores[i] for i in got]
    assert all(a >= b - 1e-4 for a, b in zip(ranked, ranked[1:]))


def test_a_seed_is_scored_by_all_its_terms():
    """Many weak terms outweigh one telling term: the neighbour that shares them comes first."""
    rng = np.random.default_rng(8)
    weak, rare = np.arange(100, 300), np.arange(1000, 1030)
    seed = np.concatenate([weak, rare]).astype(np.uint16)
    units = [seed, np.concatenate([weak, rng.integers(5000, 9000, 30)]).astype(np.uint16), np.concatenate([rare[:8], rng.integers(5000, 9000, 222)]).astype(np.uint16)]
    units += [np.concatenate([rng.choice(weak, 60, replace=False), rng.integers(9000, 20000, 170)]).astype(np.uint16) for _ in range(30)]
    df = np.zeros(tokens.IDS, np.int64)
    for u in units:
        df[np.unique(u)] += 1
    index = Index(units, df, len(units), sum(map(len, units)) / len(units), Packing())
    free = np.ones(len(units), bool)
    free[0] = False
    assert list(index.neighbours(0, free))[0] == 1
    assert len(index.asks[0]) == len(seed)
