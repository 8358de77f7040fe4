"""Toxic spans with a linear-chain conditional random field.

Labels say whether a document is toxic, not which of its tokens are. Token labels are made from them first:
a token feature (the word, its beginning or its end) that toxic documents hold far more often than others
marks the tokens that have it as toxic, in toxic documents only. On chains of consecutive tokens with these
labels a two-state chain is trained by gradient steps on its exact likelihood. Forward-backward gives each
token of a document its marginal probability; from their sum and maximum a logistic fit gives the document's
score, and runs of likely tokens are the offending spans.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import WORD, map_texts, workers_find_package
from matchspark.llm.samples import fit_logistic, sample_labels, sampled_texts, sigmoid

CHAIN = 64
#: Marks stripped from both ends of a token.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»“”‘’…|"
PARTS = (4, 5, 6)
#: Longer tokens have no word feature and aren't remembered.
LONGEST = 64
SPAN = "array<struct<start:int,end:int>>"


def token_features(token: str) -> list[str]:
    """The word in lower case without marks, its first and its last letters."""
    word = token.lower().strip(MARKS)
    if not word:
        return []
    out = ["=" + word] if len(word) <= LONGEST else []
    for n in PARTS:
        if len(word) > n:
            out += ["<" + word[:n], ">" + word[-n:]]
    return out


@dataclass(frozen=True)
class ToxicModel:
    """Weights by feature, of a marked neighbour before and after, constant, transitions, and the calibration."""

    weights: dict[str, float]
    neighbours: tuple[float, float]
    constant: float
    transitions: tuple[tuple[float, float], tuple[float, float]]
    beta: tuple[float, ...]


def forward_backward(emission: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains (rows) of two states: marginals of state 1, expected transitions (2, 2), log of the norm.

    ``emission`` is state 1's potential, state 0's is 0; places from ``lengths`` on don't count.
    """
    n, t_max = emission.shape
    hop = np.exp(transitions)
    own = np.stack([np.ones_like(emission), np.exp(np.clip(emission, -30, 30))], -1)
    alpha = np.empty((t_max, n, 2))
    scale = np.ones((t_max, n))
    for t in range(t_max):
        a = own[:, t] if t == 0 else (alpha[t - 1] @ hop) * own[:, t]
        inside = t < lengths
        scale[t] = np.where(inside, a.sum(1), 1.0)
        alpha[t] = np.where(inside[:, None], a / scale[t][:, None], alpha[t - 1] if t else a)
    beta = np.ones((n, 2))
    p = np.zeros((n, t_max))
    pairs = np.zeros((2, 2))
    for t in range(t_max - 1, -1, -1):
        inside = t < lengths
        p[:, t] = np.where(inside, alpha[t, :, 1] * beta[:, 1], 0.0)
        if t:
            after = own[:, t] * beta / scale[t][:, None]
            both = alpha[t - 1][:, :, None] * hop[None] * after[:, None, :]
            pairs += both[inside].sum(0)
            beta = np.where(inside[:, None], after @ hop.T, beta)
    return p, pairs, np.log(scale).sum(0)


def _shifted(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before, after = np.zeros(hit.shape), np.zeros(hit.shape)
    before[:, 1:], after[:, :-1] = hit[:, :-1], hit[:, 1:]
    return before, after


def train_chain(chains: list[tuple[int, list[tuple[int, int]], list[int]]], n_features: int, steps: int = 80, penalty: float = 1e-3):
    """Fit on (length, [(place, feature)], toxic places) chains; gives weights, neighbours, constant, transitions."""
    lengths = np.array([c[0] for c in chains])
    at = np.array([(i, t, f) for i, c in enumerate(chains) for t, f in c[1]], np.int64).reshape(-1, 3)
    y = np.zeros((len(chains), CHAIN))
    for i, c in enumerate(chains):
        y[i, c[2]] = 1
    flat = at[:, 0] * CHAIN + at[:, 1]
    hit = np.zeros((len(chains), CHAIN))
    hit.ravel()[flat] = 1
    before, after = _shifted(hit)
    inside = np.arange(CHAIN) < lengths[:, None]
    seen = np.zeros((2, 2))
    both = inside[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & both).sum()
    size = n_features + 3
    theta = np.zeros(size + 4)
    theta[n_features + 2] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = max(1, len(chains))
    for step in range(1, steps + 1):
        w, (u_before, u_after, c), hop = theta[:n_features], theta[n_features:size], theta[size:].reshape(2, 2)
        emission = np.bincount(flat, w[at[:, 2]], y.size).reshape(y.shape) + u_before * before + u_after * after + c
        p, pairs, _ = forward_backward(emission, lengths, hop)
        d = (p - y) * inside
        g = np.concatenate([
            np.bincount(at[:, 2], d.ravel()[flat], n_features), [(d * before).sum(), (d * after).sum(), d.sum()], (pairs - seen).ravel(),
        ]) / total + penalty * theta
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        theta -= 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * min(1.0, 2 * (1 - step / (steps + 1)))
    return theta[:n_features], tuple(theta[n_features : n_features + 2]), float(theta[n_features + 2]), tuple(map(tuple, theta[size:].reshape(2, 2)))


class Tagger:
    """Token marginals of whole texts; scores of tokens are remembered, up to a bound."""

    def __init__(self, model: ToxicModel, remembered: int = 400_000):
        self.model, self.remembered = model, remembered
        self.known: dict[bytes, float] = {}
        self.hop = np.array(model.transitions)

    def score(self, token: bytes) -> float:
        """Sum of a token's weights; exactly 0 if it has no marked feature."""
        if len(token) > 4 * LONGEST:
            return self._score(token)
        got = self.known.get(token)
        if got is None:
            if len(self.known) >= self.remembered:
                self.known.clear()
            got = self.known[token] = self._score(token)
        return got

    def _score(self, token: bytes) -> float:
        weights = self.model.weights
        return sum(weights[f] for f in token_features(token.decode()) if f in weights)

    def marginals(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text the marginals of its tokens, cut into chains of CHAIN tokens."""
        words = [t.encode().split() if t else [] for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        rows = -(-sizes // CHAIN)
        starts = np.cumsum(rows) - rows
        grid, lengths = np.zeros((int(rows.sum()), CHAIN)), np.full(int(rows.sum()), CHAIN)
        flat = grid.ravel()
        score = self.score
        for w, s, n in zip(words, starts.tolist(), sizes.tolist()):
            flat[s * CHAIN : s * CHAIN + n] = [score(x) for x in w]
            if n % CHAIN:
                lengths[s + n // CHAIN] = n % CHAIN
        before, after = _shifted(grid != 0)
        u, v = self.model.neighbours
        emission = grid + u * before + v * after + self.model.constant
        p = np.empty(grid.shape)
        for a in range(0, len(grid), 4096):
            p[a : a + 4096] = forward_backward(emission[a : a + 4096], lengths[a : a + 4096], self.hop)[0]
        flat = p.ravel()
        return [flat[s * CHAIN : s * CHAIN + n] for s, n in zip(starts.tolist(), sizes.tolist())]


def measures(p: np.ndarray) -> tuple[float, float]:
    """The largest marginal, and the expected number of toxic tokens among those that are at all likely."""
    return (float(p.max()), float(np.log1p(p[p > 0.1].sum()))) if len(p) else (0.0, 0.0)


def _feature_counts(rows: DataFrame, n_toxic: int, n_clean: int, most: int) -> list[str]:
    """Features that toxic documents hold far more often: precision 0.9 at equal numbers, and a likelihood ratio above 24."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts[label].update({f for w in set(text.as_py().encode().split()) for f in token_features(w.decode())})
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in (counts[1], counts[0]))],
            names=["feature", "toxic", "clean"],
        )

    folded = rows.select("s_label", "text").mapInArrow(run, "feature string, toxic long, clean long")
    summed = folded.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b, share = F.col("a"), F.col("b"), n_toxic / (n_toxic + n_clean)
    term = lambda seen, due: F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)
    ratio = 2 * (term(a, (a + b) * share) + term(b, (a + b) * (1 - share)))
    likely = (a / n_toxic) >= 9 * (b / n_clean)
    chosen = summed.where((a > 0) & likely & (ratio > 24)).select("feature", ratio.alias("ratio"))
    return [r.feature for r in chosen.orderBy(F.desc("ratio"), "feature").limit(most).collect()]


def train_toxic(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = 3000, most_features: int = 5000, chains_per_text: int = 2,
) -> ToxicModel:
    """Learn from about ``per_class`` toxic and as many clean rows.

    Features are counted and chains are cut on the executors: the driver gets at most ``most_features`` features,
    ``chains_per_text`` chains and two numbers of each sampled text. Rows without a label of 0 or 1 or without
    text are left out. If either class is missing, every score is the share of toxic labels.
    """
    workers_find_package(docs.sparkSession)
    usable = labels.where(F.col(f"`{label}`").isin(0, 1))
    sample = sample_labels(usable, doc_id, label, per_class)
    counted = {r.s_label: r.n for r in sample.groupBy("s_label").agg(F.count("*").alias("n")).collect()}
    empty = lambda share: ToxicModel({}, (0.0, 0.0), -20.0, ((0.0, 0.0), (0.0, 0.0)), (0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9)))))
    if len(counted) < 2:
        return empty(counted.get(1, 0) / sum(counted.values()) if counted else 0.0)
    rows = sampled_texts(docs, sample, doc_id, text).where("text <> ''")
    features = _feature_counts(rows, counted[1], counted[0], most_features)
    number = {f: i for i, f in enumerate(features)}

    def cut_chains(label: int, text: str) -> list[tuple[int, list[int], list[int]]]:
        words = text.encode().split()
        marked: dict[int, list[tuple[int, int]]] = {}
        for t, w in enumerate(words):
            for f in token_features(w.decode()):
                if f in number:
                    marked.setdefault(t // CHAIN, []).append((t % CHAIN, number[f]))
        n = -(-len(words) // CHAIN)
        chosen = sorted(marked)[:chains_per_text]
        if not label and n:  # clean text also teaches that unmarked tokens are not toxic
            chosen = sorted({*chosen, zlib.crc32(text.encode()) % n})
        return [
            {"length": min(CHAIN, len(words) - c * CHAIN), "places": [t for t, _ in marked.get(c, [])],
             "features": [f for _, f in marked.get(c, [])]}
            for c in chosen
        ]

    def cut():
        def work(texts):
            # The label travels in front of the text, parted by a line break.
            return [[cut_chains(int(t[0]), t[2:]) for t in texts]]

        return work

    tagged = rows.select("s_id", "s_label", F.concat(F.col("s_label").cast("string"), F.lit("\n"), F.col("text")).alias("text"))
    got = map_texts(tagged, "text", [("chains", "array<struct<length:int,places:array<int>,features:array<int>>>")], cut).collect()
    chains = []
    for r in sorted(got, key=lambda r: (r.s_id, r.chains)):
        for c in r.chains:
            chains.append((c.length, list(zip(c.places, c.features)), sorted(set(c.places)) if r.s_label else []))
    if not features or not chains:
        return empty(counted[1] / (counted[0] + counted[1]))
    w, neighbours, constant, transitions = train_chain(chains, len(features))
    model = ToxicModel(dict(zip(features, map(float, w))), neighbours, constant, transitions, ())

    def measure():
        tagger = Tagger(model)
        return lambda texts: [[list(measures(p)) for p in tagger.marginals(texts)]]

    held = map_texts(rows.select("s_label", "text"), "text", [("m", "array<double>")], measure).collect()
    x, y = np.array([r.m for r in held]), np.array([float(r.s_label) for r in held])
    # Sampling took the same number of both classes; weights bring back their shares among the labels.
    shares = {r.s: r.n for r in usable.groupBy(F.col(f"`{label}`").alias("s")).agg(F.count("*").alias("n")).collect()}
    weight = np.where(y == 1, shares[1] / max(1, y.sum()), shares[0] / max(1, (1 - y).sum()))
    beta = fit_logistic(x, y, weight * len(y) / weight.sum(), penalty=0.1)
    return ToxicModel(model.weights, neighbours, constant, transitions, tuple(map(float, beta)))


def spans_of(text: str, p: np.ndarray, cut: float) -> list[dict]:
    """Runs of tokens with a marginal of at least ``cut``: first and last place in code points, the end not included."""
    likely = p >= cut
    if not likely.any():
        return []
    out, last = [], -2
    for t, word in enumerate(re.finditer(WORD, text)):
        if likely[t]:
            if t == last + 1:
                out[-1]["end"] = word.end()
            else:
                out.append({"start": word.start(), "end": word.end()})
            last = t
    return out


def score_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text", cut: float = 0.5, keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1), ``predicted`` (1 from ``cut`` on) and ``spans``.

    All tokens of a text are tagged. A null or empty text has no token, the lowest score and no span. Each row is
    scored alone, so ties and repeated rows need no rule; columns named like results are replaced; an empty
    table stays empty.
    """

    def make():
        tagger, beta = Tagger(model), np.array(model.beta)

        def work(texts):
            marginals = tagger.marginals(texts)
            x = np.array([measures(p) for p in marginals]).reshape(-1, 2)
            score = sigmoid(np.column_stack([x, np.ones(len(x))]) @ beta)
            spans = [spans_of(t or "", p, cut) for t, p in zip(texts, marginals)]
            return [score.tolist(), (score >= cut).astype(int).tolist(), spans]

        return work

    return map_texts(docs, text, [("score", "double"), ("predicted", "int"), ("spans", SPAN)], make, keep_text=keep_text)
