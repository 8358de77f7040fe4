"""A quality classifier by compression: which of two dictionaries shrinks a text more?

One zstandard dictionary is built from good and one from bad labelled text. A text that is like the good
one gets smaller with the good dictionary. The difference of the two compressed sizes over their sum,
of the whole text and of its fixed chunks, goes through a logistic calibration into a score. Nothing but these differences does.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import map_texts
from matchspark.llm.samples import fit_logistic, sample_labels, sampled_texts, sigmoid

FEATURES = 6


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries of good and bad text, and the calibration; without dictionaries a constant score."""

    good: bytes
    bad: bytes
    beta: tuple[float, ...]
    constant: float
    raw: bool
    chunk: int = 1024
    level: int = 3

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        kind = zstandard.DICT_TYPE_RAWCONTENT if self.raw else zstandard.DICT_TYPE_AUTO
        made = []
        for data in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(data, dict_type=kind)
            known.precompute_compress(level=self.level)
            made.append(zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))
        return made


def differences(text: str, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor, chunk: int) -> tuple[float, ...]:
    """Normalised size differences (positive: nearer to bad text) of the whole, and of its chunks: mean, worst, best, upper
    quartile; and the share of chunks that are nearer to bad text. The last chunk ends with the text."""
    data = text.encode()
    if not data:
        return (0.0,) * FEATURES

    def one(part: bytes) -> float:
        g, b = len(good.compress(part)), len(bad.compress(part))
        return (g - b) / (g + b)

    starts = [*range(0, max(1, len(data) - chunk + 1), chunk)]
    if len(data) > chunk and len(data) % chunk:
        starts.append(len(data) - chunk)
    parts = np.array([one(data[i : i + chunk]) for i in starts])
    return one(data), parts.mean(), parts.max(), parts.min(), np.percentile(parts, 75), (parts > 0).mean() / 20


def expanded(x: np.ndarray) -> np.ndarray:
    """Features of the calibration: the differences, scaled, with the squares of their parts above and below zero."""
    d = 20.0 * x
    return np.column_stack([d, np.maximum(d, 0) ** 2 / 4, np.minimum(d, 0) ** 2 / 4])


def _dictionary(chunks: list[bytes], size: int) -> tuple[bytes, bool]:
    """A trained dictionary, or the plain text of the samples if there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, chunks).as_bytes(), False
    except zstandard.ZstdError:
        return b"\n".join(chunks)[-size:], True


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_class: int = 4000,
    chunks_per_text: int = 4,
    dictionary_bytes: int = 32_768,
    chunk: int = 1024,
) -> QualityModel:
    """Learn from at most about ``per_class`` rows of each class, half for dictionaries, half for calibration.

    The calibration rows are other rows than those in the dictionaries, and get their features on the
    executors; the driver sees ``chunks_per_text`` pieces of ``chunk`` bytes of each dictionary row, spread over the
    whole text, and six numbers of each calibration row. Labels other than 0 and 1, missing labels, and
    texts that are missing or empty are left out. If a class has no text, the score is the share of good labels.
    """
    sample = sample_labels(labels.where(F.col(f"`{label}`").isin(0, 1)), doc_id, label, per_class)
    rows = sampled_texts(docs, sample, doc_id, text).where("text <> ''")
    half = F.pmod(F.xxhash64("s_id", F.lit(7)), F.lit(2)) == 0

    def cut():
        def work(texts):
            out = []
            for t in texts:
                data = t.encode()
                n = max(1, min(chunks_per_text, len(data) // chunk))
                start = zlib.crc32(data) % chunk
                places = [min(max(0, len(data) - chunk), start + (len(data) // n) * k) for k in range(n)]
                out.append([data[p : p + chunk] for p in places])
            return [out]

        return work

    pieces = map_texts(rows.where(half), "text", [("pieces", "array<binary>")], cut).select("s_label", "pieces").collect()
    of = {0: [], 1: []}
    for r in sorted(pieces, key=lambda r: (r.s_label, r.pieces)):
        of[r.s_label] += [bytes(p) for p in r.pieces]
    n_good, n_bad = len(of[1]), len(of[0])
    if not n_good or not n_bad:
        counted = {r.s_label: r.n for r in sample.groupBy("s_label").agg(F.count("*").alias("n")).collect()}
        constant = counted.get(1, 0) / sum(counted.values()) if counted else 0.5
        return QualityModel(b"", b"", (), constant, True, chunk)
    good, raw_good = _dictionary(of[1], dictionary_bytes)
    bad, raw_bad = _dictionary(of[0], dictionary_bytes)
    if raw_good or raw_bad:
        good, bad = b"\n".join(of[1])[-dictionary_bytes:], b"\n".join(of[0])[-dictionary_bytes:]
    model = QualityModel(good, bad, (), 0.5, raw_good or raw_bad, chunk)
    held = _differences(rows.where(~half), "text", model).select("s_label", "d").collect()
    if len({r.s_label for r in held}) < 2:
        held = _differences(rows, "text", model).select("s_label", "d").collect()
    y = np.array([float(r.s_label) for r in held])
    x = expanded(np.array([r.d for r in held]))
    # Sampling took the same number of both classes; weights bring back their shares among the labels.
    shares = {r.s: r.n for r in labels.groupBy(F.col(f"`{label}`").alias("s")).agg(F.count("*").alias("n")).where("s IN (0, 1)").collect()}
    weight = np.where(y == 1, shares.get(1, 1) / max(1, y.sum()), shares.get(0, 1) / max(1, (1 - y).sum()))
    beta = fit_logistic(x, y, weight * len(y) / weight.sum(), penalty=0.1)
    return QualityModel(good, bad, tuple(beta), 0.5, raw_good or raw_bad, chunk)


def _differences(rows: DataFrame, text: str, model: QualityModel) -> DataFrame:
    def make():
        good, bad = model.compressors()
        return lambda texts: [[list(map(float, differences(t or "", good, bad, model.chunk))) for t in texts]]

    return map_texts(rows, text, [("d", "array<double>")], make)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", cut: float = 0.3, keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``cut`` on).

    Whole texts are compressed. A null or empty text scores like one of which both dictionaries make the
    same size. Each row is scored alone, so ties and repeated rows need no rule; columns named score or
    predicted are replaced; an empty table stays empty.
    """

    def make():
        if not model.beta:
            return lambda texts: [[model.constant] * len(texts), [int(model.constant >= cut)] * len(texts)]
        good, bad = model.compressors()
        beta = np.array(model.beta)

        def work(texts):
            x = np.array([differences(t or "", good, bad, model.chunk) for t in texts])
            score = sigmoid(np.column_stack([expanded(x), np.ones(len(x))]) @ beta)
            return [score.tolist(), (score >= cut).astype(int).tolist()]

        return work

    return map_texts(docs, text, [("score", "double"), ("predicted", "int")], make, keep_text=keep_text)
