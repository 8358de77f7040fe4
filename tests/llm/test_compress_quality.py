import math
import random

import zstandard

from matchspark.llm.compress_quality import differences, score_quality, train_quality

DOCS, LABELS = "doc_id long, text string, score string", "doc_id long, quality int"


def corpus(n, seed=3):
    rng = random.Random(seed)
    good = lambda: " ".join("".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(120))
    bad = lambda: " ".join("".join(rng.choice("XYZ#$%") for _ in range(rng.randint(2, 6))) for _ in range(120))
    docs, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.7)
        docs.append((i, good() if y else bad(), "s"))
        labels.append((i, y))
    return docs, labels


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus(400)
    edges = [(1000, None, None), (1001, "", None), (None, "the on an", None), (1002, "x" * 300_000, None), (1, docs[1][1], None)]
    df = spark.createDataFrame(docs + edges, DOCS)
    model = train_quality(df, spark.createDataFrame(labels[:300] + [(None, 1), (5, None), (6, 7)], LABELS), per_class=100)
    scored = score_quality(df, model, keep_text=False)
    assert scored.columns == ["doc_id", "score", "predicted"]
    got = scored.collect()
    assert len(got) == len(docs) + len(edges)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = dict(labels[300:])
    assert sum(r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth) >= 0.98 * len(truth)
    again = train_quality(df.repartition(3), spark.createDataFrame(labels[:300][::-1], LABELS), per_class=100)
    assert again.good == model.good and again.bad == model.bad


def brute_differences(text, model):
    """Sizes with either dictionary, for the whole and for chunks cut one by one."""
    kind = zstandard.DICT_TYPE_RAWCONTENT if model.raw else zstandard.DICT_TYPE_AUTO

    def size(part, known):
        made = zstandard.ZstdCompressor(
            level=model.level, dict_data=zstandard.ZstdCompressionDict(known, dict_type=kind),
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        return len(made.compress(part))

    def one(part):
        g, b = size(part, model.good), size(part, model.bad)
        return (g - b) / (g + b)

    data, parts, at = text.encode(), [], 0
    while at + model.chunk <= len(data):
        parts.append(one(data[at : at + model.chunk]))
        at += model.chunk
    if at < len(data):
        parts.append(one(data[-model.chunk :]))
    parts.sort()
    place = 0.75 * (len(parts) - 1)
    upper = parts[int(place)] + (place % 1) * (parts[math.ceil(place)] - parts[int(place)])
    return one(data), sum(parts) / len(parts), parts[-1], parts[0], upper, sum(p > 0 for p in parts) / len(parts) / 20


def test_differences_and_scores_equal_brute_force(spark):
    docs, labels = corpus(200)
    model = train_quality(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), per_class=60)
    texts = ["the", "x" * 1023, "x" * 1024, "x" * 1025, docs[0][1], "é ü " * 2000, " ".join(d[1] for d in docs[:60])]
    got = score_quality(spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], DOCS), model).collect()
    for r in got:
        want = brute_differences(texts[r.doc_id], model)
        assert [abs(a - b) < 1e-12 for a, b in zip(want, differences(texts[r.doc_id], *model.compressors(), model.chunk))] == [True] * 6
        d = [20 * x for x in want]
        z = sum(b * x for b, x in zip(model.beta, [*d, *[max(x, 0) ** 2 / 4 for x in d], *[min(x, 0) ** 2 / 4 for x in d], 1.0], strict=True))
        assert abs(r.score - 1 / (1 + math.exp(-max(-40, min(40, z))))) < 1e-9


def test_one_class_or_no_label_gives_a_constant(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, None)], DOCS)
    for labels, score in (([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)):
        model = train_quality(docs, spark.createDataFrame(labels, LABELS))
        assert {r.score for r in score_quality(docs, model).collect()} == {score}
    assert score_quality(docs.limit(0), model).count() == 0
