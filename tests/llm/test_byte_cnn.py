import random

import numpy as np

from matchspark.llm import byte_cnn as op

SCHEMA = "doc_id long, text string, lang string, score string"
SOUNDS = {"aa": ["th", "er", "ing", "wh"], "bb": ["ño", "ción", "que", "ll"], "cc": ["sch", "ü", "ß", "ei"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(8)
    rows = [(i, text(rng, lang, rng.choice([4, 40, 300])), lang, "s") for i, lang in enumerate(rng.choices(list(SOUNDS), [8, 2, 1], k=500))]
    edges = [(900, None, "aa", None), (901, "", None, None), (902, "12 34!", "bb", None), (None, "ción que", None, None), (903, text(rng, "cc", 20_000), None, None)]
    df = spark.createDataFrame(rows + edges + rows[:1], SCHEMA)
    net = op.train_languages(df, spark.createDataFrame(rows[:300], SCHEMA), per_class=60, steps=120)
    assert net.languages == ["aa", "bb", "cc"]
    got = op.predict_languages(df, net, keep_text=False)
    assert got.columns == ["doc_id", "lang", "lang_pred", "score"]
    got = got.collect()
    assert len(got) == len(rows) + len(edges) + 1
    held = [r for r in got if r.doc_id is not None and 300 <= r.doc_id < 900]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    of = {r.doc_id: r for r in got}
    assert [(of[i].lang_pred, of[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert of[None].lang_pred == "bb" and of[903].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None, None)], SCHEMA)
    assert op.train_languages(df, df) is None
    assert op.predict_languages(df, None).first().lang_pred == "und"
    net = op.train_languages(df, spark.createDataFrame([(1, "abc", "zz", None)], SCHEMA), steps=2)
    assert op.predict_languages(df, net).first().lang_pred == "zz"
    assert op.predict_languages(df.limit(0), net).count() == 0


def small_net(seed=0):
    rng = np.random.default_rng(seed)
    x = op.windows_of(bytes(rng.integers(0, 256, 700, dtype=np.uint8)), 50)
    y = np.arange(len(x)) % 3
    return op.fit(x, y, ["a", "b", "c"], 50, steps=3, batch=9), x, y


def test_tables_give_the_sums_of_the_filters():
    net, x, _ = small_net()
    here, later = net.tables()
    pairs = x[:, :-1] * op.SYMBOLS + x[:, 1:]
    folded = (here[pairs[:, :50]] + later[pairs[:, 2:52]]).max(1) + np.concatenate(net.constants)
    assert np.allclose(folded, op.forward(net, x)[1], atol=1e-4)


def test_gradients_equal_differences():
    net, x, y = small_net()
    weight = np.ones(len(x))
    for p in net.parameters():
        assert p.dtype == np.float32
    doubles = op.ByteNet(net.languages, 50, net.embedding.astype(float), [f.astype(float) for f in net.filters], [c.astype(float) for c in net.constants], net.dense.astype(float), net.offset.astype(float))
    _, grads = op.gradients(doubles, x, y, weight)
    rng = np.random.default_rng(1)
    for p, g in zip(doubles.parameters(), grads):
        for _ in range(4):
            i = tuple(rng.integers(0, n) for n in p.shape)
            old, e = p[i], 1e-6
            p[i] = old + e
            up = op.gradients(doubles, x, y, weight)[0]
            p[i] = old - e
            down = op.gradients(doubles, x, y, weight)[0]
            p[i] = old
            assert abs((up - down) / (2 * e) - g[i]) < 1e-5


def test_windows_cover_every_byte():
    data = bytes(range(1, 200)) * 3
    w = op.windows_of(data, 128)
    assert bytes(b for b in w[:, :128].ravel().tolist() if b != op.PAD) == data and (w[:, 128:] == op.PAD).all()
