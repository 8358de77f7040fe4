import functools
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from matchspark.llm import token_spans as op

SCHEMA = "doc_id long, text string, n_a string, places int, `a.b` int, pairs map<string,int>"


@functools.lru_cache
def libraries():
    made = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    made.encode_special_tokens = True
    return made, sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))


def brute_tokens(text):
    """Ids and bytes of both tokenizers straight from their vocabularies."""
    made, model = libraries()
    visible = [chr(b) for b in range(256)]
    extra = 0
    for b in range(256):
        if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b):
            visible[b] = chr(256 + extra)
            extra += 1
    back = {c: b for b, c in enumerate(visible)}
    a = [(i, bytes(back[c] for c in made.id_to_token(i))) for i in made.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    return a, b


def brute(rows):
    groups = {}
    for k, r in enumerate(rows):
        a, b = brute_tokens(r[1]) if r[1] else ([], [])
        data = (" " + (r[1] or "")).encode()
        if not r[1] or b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            groups[k] = []
            continue
        ends = [set(np.cumsum([len(x) for _, x in t]).tolist()) for t in (a, b)]
        cuts = sorted(ends[0] & ends[1])
        made = [([], []) for _ in cuts]
        for side, tokens in enumerate((a, b)):
            at = 0
            for i, x in tokens:
                at += len(x)
                made[next(g for g, c in enumerate(cuts) if c >= at)][side].append(i)
        groups[k] = made
    links = {k: [(x, y) for a, b in gs for x in a for y in b] for k, gs in groups.items()}
    count = Counter(p for pairs in links.values() for p in set(pairs))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for k, gs in groups.items():
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out.append((rows[k][0], sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links[k]),
                    sum(count[p] == most[p[0]] for p in links[k]), sum(count[p] for p in links[k]),
                    hashlib.sha256(said.encode()).hexdigest() if gs else ""))
    return sorted(out, key=str)


def texts():
    rng = random.Random(8)
    parts = ["the", "of", "Thing", "hé", "あいう", "🙂", "𐍈", "<|endoftext|>", "<s>", "\n\n", "  ", "\t", "\x00", "▁", "<0x41>", "don't", "\n", "a\nb", " \n x", "\n\nfoo", ".\n", "1234567", "naïve", "ﬁ", "Å", "​", "�", "é", "aaaaaaaa", "𝔘𝔫𝔦", "한국어"]
    out = [None, "", " ", "\n", "a", "  b", "▁", "<|endoftext|>", "𐍈", "x" * 3000, "é" * 400, "long " * 5000 + "𐍈end"]
    out += [rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    return out


@pytest.mark.parametrize("settings", [op.SpanSettings(), op.SpanSettings(chunk_pairs=40), op.SpanSettings(chunk_texts=2)])
def test_alignment_equals_brute_force(spark, settings):
    rows = [(i, t, "x", 1, 2, {"k": 1}) for i, t in enumerate(texts())]
    rows += [rows[20], (None, rows[21][1], None, None, None, None), (None, None, None, None, None, None), (rows[22][0], "another text", "", 0, 0, {})]
    got = op.align_tokens(spark.createDataFrame(rows, SCHEMA).repartition(3), settings=settings)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_wide_groups_are_linked_by_distinct_ids(monkeypatch):
    want = [found.links() for found in op.align(texts()) if found]
    monkeypatch.setattr(op, "WIDE", 0)
    got = [found.links() for found in op.align(texts()) if found]
    assert len(want) > 40 and all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(want, got))


@pytest.mark.parametrize("most", [10**9, 0, 60])
def test_segments_make_whole_texts_whatever_the_store_holds(monkeypatch, most):
    """Ids of the segments are those of the whole text, also where a character is cut into several tokens."""
    monkeypatch.setattr(op, "_MOST", most)
    op.known_segments.cache_clear()
    refinements = 0
    for at in range(0, len(texts()), 7):
        part = texts()[at : at + 7]
        for text, found in zip(part, op.align(part), strict=True):
            if found is None:
                continue
            a, b = brute_tokens(text)
            assert found.a.tolist() == [i for i, _ in a] and found.b.tolist() == [i for i, _ in b]
            refinements += "\U00010348" in text
    assert refinements


def test_a_model_with_words_of_several_segments_gets_whole_texts(monkeypatch):
    made = op.Segments(op.SpanSettings())
    assert made.apart
    made.apart = False
    monkeypatch.setattr(op, "known_segments", lambda settings: made)
    whole = list(op.align(texts()))
    assert all(len(s) == len(t) + 1 for s, t in zip(sorted(made.number, key=len), sorted(filter(None, set(texts())), key=len)))
    monkeypatch.undo()
    for a, b in zip(whole, op.align(texts()), strict=True):
        assert (a is None) == (b is None) and (a is None or all(np.array_equal(x, y) for x, y in zip(vars(a).values(), vars(b).values())))


def test_coarse_cuts_are_refined_to_the_decoded_bytes():
    # Three tokens share one character of three bytes; a second segment begins at 5.
    starts, ends = np.array([0, 2, 2, 2, 5]), np.array([2, 5, 5, 5, 7])
    lengths, begins = np.array([2, 1, 1, 1, 2]), np.array([0, 0, 0, 0, 5])
    assert op.refined(starts, ends, lengths, begins).tolist() == [2, 3, 4, 5, 7]
    assert op.refined(starts + 3, ends + 3, lengths, begins + 3).tolist() == [5, 6, 7, 8, 10]
    assert op.refined(*[np.empty(0, int)] * 4).tolist() == []


def test_groups_give_the_text_back_and_empty_tables_are_empty(spark):
    rows = [(i, t, "x", 1, 2, None) for i, t in enumerate(texts())]
    got = op.aligned_groups(spark.createDataFrame(rows, SCHEMA))
    plain_a, plain_b = op.encoder_a("byte_bpe_50k.json")[1], op.encoder_b("piece_bpe_32k.model")[1]
    read = defaultdict(list)
    for r in got.collect():
        data = [b"".join(plain[i] for i in ids) for plain, ids in ((plain_a, r.a_ids), (plain_b, r.b_ids))]
        assert data[0] == data[1] and len(data[0]) == r.stop - r.start
        read[r.doc_id].append((r.start, data[0]))
    for doc_id, parts in read.items():
        assert b"".join(d for _, d in sorted(parts)).decode() == " " + rows[doc_id][1]
    assert set(read) == {i for i, found in enumerate(op.align(texts())) if found}
    empty = spark.createDataFrame([], "`the id` string, body string")
    assert op.align_tokens(empty, "the id", "body").collect() == []
    one = op.align_tokens(spark.createDataFrame([("k", None)], empty.schema), "the id", "body").collect()
    assert [tuple(r) for r in one] == [("k", 0, 0, 0, 0, 0, 0, "")]
