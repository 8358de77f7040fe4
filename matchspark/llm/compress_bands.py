"""Quality rules by compression bands.

How far zstandard shrinks a text tells repetitive text (shrinks too well) and noise (hardly shrinks) from
prose. Ratios are raw bytes over compressed bytes, of the whole document and of fixed chunks, and each
length band has limits of its own, because short texts shrink less.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from matchspark.llm.common import SPACES, map_texts

#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
BASE = (
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
    ("n_repeat_words", "long"), ("base_failed", "boolean"),
)
RESULT = (*BASE, ("ratio", "double"), ("chunk_low", "double"), ("chunk_high", "double"), ("kept", "boolean"))


@dataclass(frozen=True)
class Bands:
    """Limits of the ratios: for texts of up to so many bytes, the smallest and largest ratio that passes.

    ``chunk`` bytes are the size of a fixed chunk; ``chunk_limits`` are for full chunks. A document is rejected
    if its own ratio is out of its band, if any full chunk is beyond ``worst`` limits, or if more than
    ``share`` of its full chunks are out of ``chunk_limits``.
    """

    limits: tuple[tuple[float, float, float], ...] = (
        (128, 0.40, 1.75), (256, 0.70, 1.85), (512, 1.10, 2.02), (1024, 1.20, 2.12), (2048, 1.35, 2.27),
        (8192, 1.50, 2.47), (float("inf"), 1.60, 2.70),
    )
    chunk: int = 2048
    chunk_limits: tuple[float, float] = (1.40, 2.28)
    worst: tuple[float, float] = (1.20, 2.60)
    share: float = 0.25
    level: int = 3
    min_words: int = 50
    repeat_percent: int = 50
    edges: np.ndarray = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "edges", np.array([b for b, _, _ in self.limits]))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs at least twice in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = (h[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (h[2:] * np.uint64(0x165667B19E3779F9))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    # Equal windows have equal keys; the windows themselves decide.
    places = np.flatnonzero(twice).tolist()
    first: dict[tuple[bytes, bytes, bytes], int] = {}
    covered = np.zeros(n + 2, bool)
    for i in places:
        window = (words[i], words[i + 1], words[i + 2])
        j = first.setdefault(window, i)
        if j != i:
            covered[i : i + 3] = True
            covered[j : j + 3] = True
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def text_measures(text: str, bands: Bands, compress) -> tuple:
    """The result columns for one whole text; ``compress`` gives the compressed size of bytes."""
    data = text.encode()
    words = data.split()  # on exactly the six characters of SPACES
    n_words = len(words)
    repeats = repeated_words(words)
    failed = n_words < bands.min_words or 100 * repeats > bands.repeat_percent * n_words
    ratio = len(data) / compress(data) if data else 1.0
    size = bands.chunk
    starts = [*range(0, len(data) - size + 1, size)]
    if len(data) > size and len(data) % size:
        starts.append(len(data) - size)
    chunks = [size / compress(data[i : i + size]) for i in starts]
    low, high = (min(chunks), max(chunks)) if chunks else (None, None)
    _, least, most = bands.limits[int(np.searchsorted(bands.edges, len(data)))]
    good = least <= ratio <= most
    if chunks:
        a, b = bands.chunk_limits
        outside = sum(not a <= c <= b for c in chunks)
        good = good and bands.worst[0] <= low and high <= bands.worst[1] and outside <= bands.share * len(chunks)
    chars = len(text) - sum(map(text.count, SPACES))
    return (
        n_words, chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats, failed, ratio, low, high,
        good and not failed,
    )


def compression_bands(docs: DataFrame, text: str = "text", bands: Bands = Bands(), keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with word counts, compression ratios and whether it is kept.

    Words are runs of characters other than space and U+0009 to U+000D. Chunks follow each other from the start; a last one ends with
    the text, so every byte of a text that isn't shorter than a chunk is judged in a chunk. ``chunk_low`` and ``chunk_high`` are
    the ratios of the least and most compressible chunk, null for texts shorter than a chunk. A null text
    has no words, fails the base rules and isn't kept, like an empty one. Each row is judged alone, so ties
    and repeated rows need no rule; columns named like results are replaced; an empty table stays empty.
    """

    def make():
        compressor = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)
        size = lambda data: len(compressor.compress(data))
        return lambda texts: list(zip(*(text_measures(t or "", bands, size) for t in texts)))

    return map_texts(docs, text, list(RESULT), make, keep_text=keep_text)
