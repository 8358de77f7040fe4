"""Token ids of whole texts, as the ``tokenizers`` library gives them for a byte-level BPE file.

Most texts are encoded with ``tiktoken`` from the same vocabulary, which is several times as fast, and with a pattern
without lookahead, for which white space is cut beforehand where the vocabulary's own pattern would. It is used
only for texts made of characters that both libraries class alike (``COMMON``, compared one by one in the
tests) and that hold neither the special token's string nor very long runs; all other texts go to ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np

VOCABULARY = "byte_bpe_50k"
#: Ids are below this, so they fit 16 bits.
IDS = 50_257
#: Fixed value: the special token of the vocabulary.
SPECIAL = "<|endoftext|>"
#: Latin letters with their marks, ASCII, and general punctuation.
COMMON = "\x00-ſ‐-‧"
_OTHER = re.compile(f"[^{COMMON}]")
#: Runs without a break cost the fast library more than their length; short texts can't have long ones.
_RUN = re.compile(r"\S{5000}|\s{500}")
_SHORT = 20_000
#: White space among ``COMMON``.
_SPACES = " \t\n\x0b\x0c\r\x85\xa0"
_TWO_SPACES = re.compile(f"[{_SPACES}]{{2}}")
#: Before the last of several white space characters, if a word follows: that one belongs to the word or stands alone.
_LAST_SPACE = re.compile(f"(?<=[{_SPACES}])(?=[{_SPACES}][^{_SPACES}])")
#: Fixed value: the vocabulary's pattern without its rule for white space that ends before a word.
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


@functools.lru_cache(maxsize=2)
def exact_encoder(name: str = VOCABULARY):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(public_tokenizers.path(f"{name}.json")))


@functools.lru_cache(maxsize=2)
def fast_encoder(name: str = VOCABULARY):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PLAIN, mergeable_ranks=ranks, special_tokens={})


def is_common(text: str) -> bool:
    if SPECIAL in text or not (text.isascii() or not _OTHER.search(text)):
        return False
    return len(text) <= _SHORT or not _RUN.search(text)


def encode(text: str, name: str = VOCABULARY) -> np.ndarray:
    """Ids of a whole text, without special tokens added."""
    if is_common(text):
        fast = fast_encoder(name).encode_ordinary
        if not _TWO_SPACES.search(text):
            return np.array(fast(text), np.uint16)
        return np.concatenate([np.array(fast(part), np.uint16) for part in _LAST_SPACE.split(text)])
    return np.array(exact_encoder(name).encode(text, add_special_tokens=False).ids, np.uint16)
