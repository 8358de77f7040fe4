import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from matchspark.llm import prefix_trie as op

SCHEMA = "conv_id long, turn int, role string, text string, depth string, `a.b` int, hi map<string,int>"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs[conv].append(((turn is not None, turn or 0), digest, role, text))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children, inside = defaultdict(list), defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
        for d in range(len(p) + 1):
            inside[p[:d]].append(p)
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(p))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) if q else 0 for q in inside[p])
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]),
                    sum(not children[q] for q in inside[p]), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed=5, n=160):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-12, n), n * 2 // 3):
        for turn in range(rng.choice([1, 2, 3, 4, 8, 12])):
            said = rng.choice(["hi", "hi", "hi", "あé", "", None]) if turn < 4 else f"t{rng.randint(0, 3)}"
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "user", None]), said, "x", 1, {"k": 1}))
    rows += [rows[0], rows[0], (None, 1, "user", "hi", "x", 1, None), (4, 9, "user", "long " * 50_000, "x", 1, None)]
    rows += [(10_000_000_000, t, "u", f"{t}", "", 0, None) for t in range(400)]
    return rows


@pytest.mark.parametrize(
    "settings", [op.TrieSettings(), op.TrieSettings(light_members=3), op.TrieSettings(light_members=1, queue=2), op.TrieSettings(queue=3)]
)
def test_trie_equals_brute_force(spark, settings):
    rows = conversations()
    got = op.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), settings=settings)
    assert got.columns == NAMES
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_limit_of_heavy_nodes_follows_the_table(spark):
    rows = conversations(6, 90)
    settings = op.TrieSettings(light_members=1, most_heavy=8)
    assert sorted((tuple(r) for r in op.prefix_trie(spark.createDataFrame(rows, SCHEMA), settings=settings).collect()), key=str) == brute(rows)


def test_empty_table_has_no_node_and_names_are_parameters(spark):
    assert op.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(3, 1.0, "user", "a"), (3, 0.0, None, None), (None, 1.0, "user", "b")]
    got = op.prefix_trie(spark.createDataFrame(rows, "`the id` int, n double, who string, said string"), "the id", "n", "who", "said")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_spilling_queue_gives_back_everything_in_order():
    rng = random.Random(1)
    for limit in (1, 3, 50):
        queue, want, got = op.SpillingQueue(2, limit), [], []
        for _ in range(1000):
            if want and rng.random() < 0.4:
                want.sort()
                assert queue.first() == want[0]
                got.append(queue.pop())
                assert got[-1] == want.pop(0)
            else:
                item = (rng.randint(-5, 5), rng.randint(-(1 << 62), 1 << 62))
                queue.push(item)
                want.append(item)
        assert [queue.pop() for _ in range(len(want))] == sorted(want) and queue.first() is None
        assert queue.spills > 0 or limit == 50


def test_missing_parent_is_an_error():
    node = (1, 1, 3, 7, 2, 2, 1, 5, False, 0, 0, 0)
    with pytest.raises(ValueError):
        list(op.subtree_totals(iter([node]), 10))
