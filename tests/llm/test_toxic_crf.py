import random
from itertools import product

import numpy as np

from matchspark.llm import toxic_crf as op

DOCS, LABELS = "doc_id long, text string, spans string", "doc_id long, toxic int"


def corpus(n, seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "li"]) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.choice([30, 200]))]
        y = int(rng.random() < 0.2)
        for _ in range(rng.randint(1, 3) * y):
            words[rng.randrange(len(words))] = rng.choice(["Vilest,", "grumpf" + word(), "GRUMPF" + word() + "!"])
        docs.append((i, " ".join(words), "s"))
        labels.append((i, y))
    return docs, labels


def test_held_out_rows_and_spans(spark):
    docs, labels = corpus(900)
    edges = [(2000, None, None), (2001, "", None), (None, "é grumpfzz\tvilest er", None), (2002, "er " * 50_000 + "vilest", None), (2003, "x" * 100_000, None)]
    df = spark.createDataFrame(docs + edges + docs[:1], DOCS)
    model = op.train_toxic(df, spark.createDataFrame(labels[:600] + [(None, 1), (3, None), (4, 9)], LABELS))
    got = op.score_toxicity(df, model, keep_text=False)
    assert got.columns == ["doc_id", "score", "predicted", "spans"]
    got = got.collect()
    assert len(got) == len(docs) + len(edges) + 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth, of = dict(labels[600:]), {r.doc_id: r for r in got}
    assert sum(of[i].predicted == y for i, y in truth.items()) >= 0.99 * len(truth)
    assert of[2000].score == of[2001].score < 0.5 and of[2000].spans == of[2001].spans == []
    assert [(s.start, s.end) for s in of[None].spans] == [(2, 17)]
    assert [(s.start, s.end) for s in of[2002].spans] == [(150_000, 150_006)] and of[2002].predicted == 1


def test_one_class_or_no_label(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, None, None)], DOCS)
    for labels, low, high in (([], 0, 0.01), ([(1, 0)], 0, 0.01), ([(1, 1), (2, 1)], 0.99, 1)):
        model = op.train_toxic(docs, spark.createDataFrame(labels, LABELS))
        assert all(low <= r.score <= high for r in op.score_toxicity(docs, model).collect())
    assert op.score_toxicity(docs.limit(0), model).count() == 0


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(6)
    emission, lengths, hop = rng.normal(size=(5, 6)), np.array([6, 1, 4, 3, 5]), rng.normal(size=(2, 2))
    p, pairs, norm = op.forward_backward(emission, lengths, hop)
    want_pairs = np.zeros((2, 2))
    for i, n in enumerate(lengths):
        total, ones, seen = 0.0, np.zeros(6), np.zeros((2, 2))
        for path in product((0, 1), repeat=int(n)):
            weight = np.exp(sum(emission[i, t] for t in range(n) if path[t]) + sum(hop[a, b] for a, b in zip(path, path[1:])))
            total += weight
            ones[: int(n)] += weight * np.array(path)
            for a, b in zip(path, path[1:]):
                seen[a, b] += weight
        assert np.allclose(p[i], ones / total) and np.isclose(norm[i], np.log(total))
        want_pairs += seen / total
    assert np.allclose(pairs, want_pairs)
