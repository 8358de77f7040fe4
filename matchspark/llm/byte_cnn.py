"""Language identification with a convolutional network over bytes.

A window of bytes goes through an embedding, filters of several widths, max pooling over the window and a
softmax. It is trained with Adam in numpy on windows of labelled text. For use, embedding and filters are
folded into two tables over pairs of neighbouring bytes, which give the same numbers: the filters' sums at a
place are one row of each table. Documents are cut into consecutive windows to their very end, and the
windows' probabilities are averaged by their bytes.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import map_texts
from matchspark.llm.samples import sample_labels, sampled_texts

#: Stands for the bytes behind the end of a window.
PAD = 256
SYMBOLS = 257
WIDTHS = (2, 3, 4)
REACH = max(WIDTHS) - 1
UNKNOWN = "und"


@dataclass
class ByteNet:
    """Parameters: embedding, filters and constants per width, and the softmax layer."""

    languages: list[str]
    window: int
    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, embedding, filters)
    constants: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.constants, self.dense, self.offset]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows by (byte, next byte): what the two bytes add to every filter at their place, and two places before."""
        here, later = [], []
        for f in self.filters:
            by_byte = [self.embedding @ f[k] for k in range(len(f))] + [np.zeros((SYMBOLS, f.shape[2]))] * (4 - len(f))
            here.append((by_byte[0][:, None, :] + by_byte[1][None, :, :]).reshape(SYMBOLS * SYMBOLS, -1))
            later.append((by_byte[2][:, None, :] + by_byte[3][None, :, :]).reshape(SYMBOLS * SYMBOLS, -1))
        return (np.ascontiguousarray(np.concatenate(t, 1), np.float32) for t in (here, later))


def windows_of(data: bytes, window: int) -> np.ndarray:
    """Consecutive windows over all bytes, each followed by padding."""
    n = max(1, -(-len(data) // window))
    flat = np.full(n * window, PAD, np.int32)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    return np.pad(flat.reshape(n, window), ((0, 0), (0, REACH)), constant_values=PAD)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def forward(net: ByteNet, x: np.ndarray) -> tuple:
    """Pooled values, the places of the maxima per width, and probabilities."""
    embedded = net.embedding[x]
    pooled, places = [], []
    for f, c in zip(net.filters, net.constants):
        sums = sum(embedded[:, k : k + net.window] @ f[k] for k in range(len(f)))
        place = sums.argmax(1)
        places.append(place)
        pooled.append(np.take_along_axis(sums, place[:, None, :], 1)[:, 0] + c)
    raw = np.concatenate(pooled, 1)
    return embedded, raw, places, softmax(np.maximum(raw, 0) @ net.dense + net.offset)


def gradients(net: ByteNet, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    embedded, raw, places, p = forward(net, x)
    rows = np.arange(len(x))
    loss = float(-(weight * np.log(p[rows, y] + 1e-12)).sum() / weight.sum())
    d = p.copy()
    d[rows, y] -= 1
    d *= (weight / weight.sum())[:, None]
    hidden = np.maximum(raw, 0)
    d_dense, d_offset = hidden.T @ d, d.sum(0)
    d_raw = (d @ net.dense.T) * (raw > 0)
    d_embedding = np.zeros_like(net.embedding)
    d_filters, d_constants, at = [], [], 0
    for f, place in zip(net.filters, places):
        g = d_raw[:, at : at + f.shape[2]]
        at += f.shape[2]
        d_f = np.zeros_like(f)
        for k in range(len(f)):
            # Only the place of the maximum passes a gradient on: (rows, filters, embedding).
            seen = embedded[rows[:, None], place + k]
            d_f[k] = np.einsum("nf,nfe->ef", g, seen)
            np.add.at(d_embedding, x[rows[:, None], place + k], g[:, :, None] * f[k].T[None])
        d_filters.append(d_f)
        d_constants.append(g.sum(0))
    return loss, [d_embedding, *d_filters, *d_constants, d_dense, d_offset]


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], window: int, size: int = 8, filters: int = 10,
        steps: int = 500, batch: int = 192, rate: float = 0.01, seed: int = 1) -> ByteNet:
    """Adam on batches drawn with equal chances for all languages."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    net = ByteNet(
        languages, window, draw(SYMBOLS, size, scale=0.5), [draw(w, size, filters, scale=(w * size) ** -0.5) for w in WIDTHS],
        [np.zeros(filters, np.float32) for _ in WIDTHS], draw(filters * len(WIDTHS), len(languages), scale=0.1),
        np.zeros(len(languages), np.float32),
    )
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    of = [np.flatnonzero(y == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(rows, -(-batch // len(of))) for rows in of])
        _, grads = gradients(net, x[chosen], y[chosen], np.ones(len(chosen), np.float32))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, (m, v) in zip(net.parameters(), grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def train_languages(
    docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang",
    per_class: int = 800, windows_per_text: int = 8, window: int = 128, steps: int = 600,
) -> ByteNet | None:
    """Train on about ``per_class`` labelled rows per language, ``windows_per_text`` windows spread over each whole text.

    ``labelled`` has the ids and labels that may be learned from; rows without either, and without text, are left
    out. Windows are cut on the executors, so the driver sees a number of bytes bounded by these parameters.
    None if there is nothing to learn from.
    """
    sample = sample_labels(labelled, doc_id, label, per_class)
    if sample.isEmpty():
        return None

    def cut():
        def work(texts):
            out = []
            for t in texts:
                data = t.encode()
                n = -(-len(data) // window)
                first = zlib.crc32(data) % n
                chosen = sorted({(first + k * n // windows_per_text) % n for k in range(windows_per_text)})
                out.append([data[c * window : (c + 1) * window] for c in chosen])
            return [out]

        return work

    rows = sampled_texts(docs, sample, doc_id, text).where("text <> ''")
    got = map_texts(rows, "text", [("windows", "array<binary>")], cut).select("s_label", "windows").collect()
    if not got:
        return None
    pairs = sorted((r.s_label, bytes(w)) for r in got for w in r.windows)
    languages = sorted({lang for lang, _ in pairs})
    x = np.concatenate([windows_of(w, window) for _, w in pairs])
    y = np.array([languages.index(lang) for lang, _ in pairs])
    return fit(x, y, languages, window, steps=steps)


def predict_languages(
    docs: DataFrame, net: ByteNet | None, text: str = "text", keep_text: bool = True, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred``, a learned language or ``und``, and ``score``, its probability.

    Whole texts are read. A text that is null, empty or without any letter is ``und`` with score 0, and so is every
    text if nothing was learned. Ties go to the language that sorts first. Each row is judged alone, so repeated
    rows need no rule; columns named like results are replaced (``names`` gives other names); an empty table stays empty.
    """
    sent = None if net is None else (net.languages, net.window, *net.tables(), np.concatenate(net.constants), net.dense, net.offset)

    def make():
        import regex

        letter = regex.compile(r"\p{L}")
        if sent is None:
            return lambda texts: [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        languages, window, here, later, constants, dense, offset = sent
        step = 64
        first = np.empty((step * window, here.shape[1]), np.float32)
        second = np.empty_like(first)

        def probabilities(x: np.ndarray) -> np.ndarray:
            out = np.empty((len(x), len(languages)), np.float32)
            for a in range(0, len(x), step):
                part = x[a : a + step]
                pairs = part[:, :-1] * SYMBOLS + part[:, 1:]
                n = len(part) * window
                np.take(here, pairs[:, :window].ravel(), 0, first[:n], "clip")
                np.take(later, pairs[:, 2 : window + 2].ravel(), 0, second[:n], "clip")
                np.add(first[:n], second[:n], first[:n])
                pooled = first[:n].reshape(len(part), window, -1).max(1)
                out[a : a + step] = softmax(np.maximum(pooled + constants, 0) @ dense + offset)
            return out

        def work(texts):
            known = [i for i, t in enumerate(texts) if t and letter.search(t)]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            at = 0
            while at < len(known):
                blocks, sizes, held, start = [], [], 0, at
                while at < len(known) and (not blocks or held < 2_000_000):
                    data = texts[known[at]].encode()
                    blocks.append(windows_of(data, window))
                    sizes.append(len(data))
                    held += len(data)
                    at += 1
                p = probabilities(np.concatenate(blocks))
                counts = np.array([len(b) for b in blocks])
                ends = np.cumsum(counts)
                weight = np.full(len(p), float(window), np.float32)
                weight[ends - 1] = np.array(sizes) - (counts - 1) * window
                mean = np.add.reduceat(p * weight[:, None], ends - counts, axis=0).astype(float) / np.array(sizes)[:, None]
                best = mean.argmax(1)
                for k, i in enumerate(known[start:at]):
                    names[i], scores[i] = languages[best[k]], float(min(1.0, mean[k, best[k]]))
            return [names, scores]

        return work

    return map_texts(docs, text, [(names[0], "string"), (names[1], "double")], make, keep_text=keep_text)


def confidence_limit(named: DataFrame, lang: str, names: tuple[str, str] = ("lang_pred", "score"), lost: float = 0.001, most: float = 0.5) -> float:
    """The score below which a prediction is not to be trusted: at most ``most``, and so that a share of at most ``lost`` of
    the rightly predicted rows of ``named`` lies below. Rows that the net has learned from don't belong there; without rows it is 0."""
    right = named.where(F.col(f"`{lang}`") == F.col(names[0]))
    found = right.agg(F.percentile_approx(names[1], lost, 100_000)).first()[0]
    return min(found or 0.0, most)
