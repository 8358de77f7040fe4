import random
import re

import pytest
import xxhash

from matchspark.llm import simhash_pivots as op
from matchspark.llm.components import components

SCHEMA = "doc_id long, text string, fingerprint string, component_id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    """Smallest index reachable over pairs within 2 bits."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_groups_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["Aé", "b", "the", "of", "zz", "Q", "lorem", "ipsum"]
    texts = [None, "", " \n", "one", "one", "one two", "ONE two", "A B c d", "x y z", "x" * 100_000 + " y z w"]
    for _ in range(12):
        base = [rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.choice([5, 150, 400]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "edit" + str(rng.randint(0, 9))
            texts.append(rng.choice([" ", "\t\x0b"]).join(copy))
    prints = [brute_print(t) for t in texts]
    assert op.fingerprints(texts).tolist() == prints
    ids = [7 * i + 3 for i in range(len(texts))]
    rows = [(i, t, "f", "c") for i, t in zip(ids, texts)]
    want = {(i, f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, brute_roots(prints))}
    for crowd in (64, 2):
        got = op.near_duplicates(spark.createDataFrame(rows, SCHEMA), crowd=crowd)
        assert {tuple(r) for r in got.collect()} == want
    left = op.drop_near_copies(spark.createDataFrame(rows + [rows[3], (None, "null id alone", None, None)], "doc_id long, text string, g_id string, of string"))
    assert left.columns == ["doc_id", "text", "g_id", "of"]
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted({c for _, _, c in want})


def test_unlike_texts_stay_under_one_id_and_under_none(spark):
    rng = random.Random(9)
    unlike = [" ".join(f"w{rng.randint(0, 10_000)}" for _ in range(300)) for _ in range(9)]
    prints = [brute_print(t) for t in unlike]
    assert brute_roots(prints) == list(range(9))
    low = [t.lower() for t in unlike]
    rows = [(7, t, "a") for t in unlike[:3]] + [(None, t, "a") for t in unlike[3:7]] + [(None, low[3].replace(" ", "\t"), "near"), (None, unlike[4], "b")]
    rows += [(3, unlike[7], "a"), (3, unlike[7].replace(" ", "\n"), "near"), (None, unlike[7], "null"), (3, unlike[7], "b"), (5, unlike[8], "a"), (6, unlike[8], "a")]
    left = op.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, note string")).collect()
    by_print = {brute_print(r.text): r for r in left}
    assert len(left) == 9 and set(by_print) == set(prints)
    assert [by_print[p].doc_id for p in prints] == [7] * 3 + [None] * 4 + [3, 5]
    assert by_print[prints[4]].note == "b"


@pytest.mark.parametrize(("groups", "crowd"), [(4, 64), (5, 64), (4, 3)])
def test_links_give_exactly_the_classes_within_two_bits(spark, groups, crowd):
    rng = random.Random(groups * crowd)
    points = {0, (1 << 64) - 1, 1, 3, 7}
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            points.add(x)
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
    points = sorted(points)
    df = spark.createDataFrame([(op.signed(p),) for p in points], "fp long")
    links = op.pivot_links(df, groups=groups, crowd=crowd)
    found = {}
    for r in components(links).collect():
        found.setdefault(r.root, set()).add(r.node % (1 << 64))
    want = {}
    for p, root in zip(points, brute_roots(points)):
        want.setdefault(root, set()).add(p)
    assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_empty_and_chain(spark):
    assert op.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(5, 5), (99, 98)], "u long, v long")
    assert {tuple(r) for r in components(chain).collect()} == {(i, 0) for i in range(41)} | {(98, 98), (99, 98)}
