"""Alignment of two tokenizers on byte spans, and how usual the linked pairs of ids are in the corpus.

1. A text is encoded by a byte-level BPE with character offsets and by a sentencepiece model with byte spans. Both are
   taken as coarse cuts. Where a token's span isn't as long as its decoded bytes (parts of a character of several bytes,
   byte-fallback pieces), the cuts of that run of tokens are laid by the decoded bytes. The decoded bytes must be the text's.
   No token of either reaches over a space or line break behind a character that isn't white space, so a text is cut into segments
   there, and a worker encodes each distinct segment once, many at a time. A model that has such a token is given whole texts.
2. Offsets at which tokens of both end cut them into groups. Pairs of ids of a group are links; a text keeps its
   distinct pairs with their numbers.
3. Texts are taken in chunks of a bounded number of pairs. A chunk counts its texts per pair once, texts refer to pairs by
   their place in the chunk. Counts are summed over chunks, looked up per chunk and pair, and come back
   to the chunk's texts. A frequent pair is one row per chunk, not per text.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from matchspark.llm.common import slices, workers_find_package
from matchspark.session import cut_lineage

#: A pair of ids is ``a * B_SPACE + b``.
B_SPACE = 1 << 20
#: Groups with more links than this are linked by distinct ids instead of occurrence by occurrence.
WIDE = 4096
#: A space or line break and what follows, up to the next one behind a character that isn't white space.
_SEGMENT = re.compile(r"[ \n][^ \n]*(?:(?<=\s)[ \n][^ \n]*)*")
#: Tokens of a worker's store; a full one is emptied and fills again.
_MOST = 5_000_000


@dataclass(frozen=True)
class SpanSettings:
    """Names of the two vocabularies; pairs and texts of a chunk from which on it is closed."""

    a: str = "byte_bpe_50k.json"
    b: str = "piece_bpe_32k.model"
    chunk_pairs: int = 1_500_000
    chunk_texts: int = 20_000


def byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary to byte: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@functools.lru_cache(maxsize=2)
def encoder_a(name: str):
    """The tokenizer, and the decoded bytes of all of its ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(str(public_tokenizers.path(name)))
    made.encode_special_tokens = True
    alphabet = byte_alphabet()
    entries = [made.id_to_token(i) or "" for i in range(made.get_vocab_size())]
    # Entries outside the alphabet are special tokens, which texts never become.
    return made, [bytes(alphabet[c] for c in e) if all(c in alphabet for c in e) else e.encode() for e in entries]


@functools.lru_cache(maxsize=2)
def encoder_b(name: str):
    """The model, the decoded bytes of all of its pieces, and the id of unknown pieces."""
    import public_tokenizers
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(name)))
    pieces = [made.id_to_piece(i) for i in range(made.get_piece_size())]
    plain = [bytes([int(p[3:5], 16)]) if made.is_byte(i) else decoded_piece(p) for i, p in enumerate(pieces)]
    return made, plain, made.unk_id()


def decoded_piece(piece: str) -> bytes:
    return piece.replace("▁", " ").encode()


def refined(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: the coarse ones, and where a token's span has another length than its decoded bytes, their place.

    ``begins`` is where the segment of each token begins; its tokens' decoded bytes follow each other from there.
    """
    laid = np.cumsum(lengths)
    first = np.concatenate([np.ones(min(1, len(begins)), bool), begins[1:] != begins[:-1]])
    before = (laid - lengths)[first][np.cumsum(first) - 1]
    return np.where(ends - starts == lengths, ends, begins + laid - before)


@dataclass(frozen=True)
class Alignment:
    """Ids of both tokenizers, for every token the group it lies in, the number of groups, and the groups
    as ``a1,a2|b1;a3|b2,b3`` with a semicolon in front."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int
    written: bytes

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of ids of this text, and how many links each has."""
        group_a, group_b, n = self.group_a, self.group_b, self.n_groups
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        each = np.where(in_a * in_b > WIDE, 0, in_b)[group_a]
        total = int(each.sum())
        inner = np.arange(total) - np.repeat(np.cumsum(each) - each, each)
        keys = np.repeat(self.a, each) * B_SPACE + self.b[np.repeat(first_b[group_a], each) + inner]
        found, counts = np.unique(keys, return_counts=True)
        wide = np.flatnonzero(in_a * in_b > WIDE)
        if not len(wide):
            return found, counts
        more, times = [found], [counts]
        for g in wide.tolist():
            ids_a, n_a = np.unique(self.a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            ids_b, n_b = np.unique(self.b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            more.append((ids_a[:, None] * B_SPACE + ids_b).ravel())
            times.append((n_a[:, None] * n_b).ravel())
        found, at = np.unique(np.concatenate(more), return_inverse=True)
        summed = np.zeros(len(found), np.int64)
        np.add.at(summed, at, np.concatenate(times))
        return found, summed


class Segments:
    """Encoded segments, one behind the other; a segment's number tells where its tokens and groups are."""

    def __init__(self, settings: SpanSettings):
        self.settings, self.words = settings, group_text(settings.a, settings.b)
        self.a, self.plain_a = encoder_a(settings.a)
        self.b, self.plain_b, self.unknown = encoder_b(settings.b)
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in plain], np.int64) for plain in (self.plain_a, self.plain_b))
        # The other tokenizer's pattern keeps white space apart from characters before it.
        over = re.compile(r"\S[ \n]|.\n|\n.", re.DOTALL)
        self.apart = not any(over.search(p.decode(errors="replace")) for p in self.plain_b)
        self.lead = self.b.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        none = np.empty(0, np.int32)
        self.ids, self.groups = [none, none], [none, none]
        self.firsts, self.sizes = [np.empty(0, np.int64)] * 2, [np.empty(0, np.int64)] * 2
        self.n_groups, self.fits = np.empty(0, np.int64), np.empty(0, bool)
        self.written: list[bytes] = []

    def learn(self, segments: set[str]) -> None:
        new = [s for s in segments if s not in self.number]
        if sum(map(len, self.ids)) > _MOST:
            self.forget()
            new = list(segments)
        if not new:
            return
        # Millions of small objects and no cycles: the collector would walk over them again and again.
        gc.disable()
        try:
            self._add(new)
        finally:
            gc.freeze()
            gc.enable()

    def _add(self, new: list[str]) -> None:
        data = "".join(new).encode()
        chars = np.array([len(s) for s in new], np.int64)
        starts = np.concatenate([[0], np.cumsum(chars)])
        place = _byte_places("".join(new), len(data))
        ends = place[starts[1:]]
        coded_a = self.a.encode_batch(new, add_special_tokens=False)
        # The model puts a space in front itself: the segment's own, or one piece more before a line break.
        coded_b = self.b.encode([s[1:] if s[0] == " " else s for s in new], return_type="proto", num_threads=1)
        ids_a, offsets, pieces, size_a, size_b = [], [], [], [], []
        for segment, a, b in zip(new, coded_a, coded_b):
            found = [(p.id, p.begin, p.end) for p in b.pieces]
            if segment[0] != " ":
                found = found[1:] if found[0] == (self.lead, 0, 0) else []
            ids_a += a.ids
            offsets += a.offsets
            pieces += found
            size_a.append(len(a))
            size_b.append(len(found))
        sizes = np.array(size_a), np.array(size_b)
        a, spans = np.array(ids_a, np.int64), _flat(offsets, 2)
        b, begin, end = _flat(pieces, 3).T
        bytes_b, lengths_b = [self.plain_b[i] for i in b.tolist()], self.lengths_b[b]
        if (odd := np.flatnonzero(b == self.unknown)).size:
            told = [p.piece for s, c in zip(new, coded_b) for p in c.pieces[s[0] != " " :]]
            for i in odd.tolist():
                bytes_b[i] = decoded_piece(told[i])
            lengths_b = np.array([len(x) for x in bytes_b], np.int64)
        fits = _given_back(data, ends, sizes, ([self.plain_a[i] for i in ids_a], bytes_b), (self.lengths_a[a], lengths_b))
        if not fits.all():
            # Segments that aren't given back have no tokens.
            in_a, in_b = (np.repeat(fits, n) for n in sizes)
            a, spans, b, begin, end, lengths_b = a[in_a], spans[in_a], b[in_b], begin[in_b], end[in_b], lengths_b[in_b]
            sizes = tuple(np.where(fits, n, 0) for n in sizes)
        # Offsets count characters of the segment; spans count its bytes without a space in front, which the first piece gets.
        spans = place[spans + np.repeat(starts[:-1], sizes[0])[:, None]]
        begins_a, begins_b = (np.repeat(place[starts[:-1]], n) for n in sizes)
        spaces = np.repeat(np.array([s[0] == " " for s in new], np.int64), sizes[1])
        leads = np.concatenate([np.ones(min(1, len(b)), bool), begins_b[1:] != begins_b[:-1]])
        ends_a = refined(spans[:, 0], spans[:, 1], self.lengths_a[a], begins_a)
        ends_b = refined(begins_b + np.where(leads, 0, begin + spaces), begins_b + end + spaces, lengths_b, begins_b)
        cuts = np.intersect1d(ends_a, ends_b)
        upto = np.searchsorted(cuts, ends, side="right")
        n_groups = np.diff(upto, prepend=0)
        self.written += self._written(a, b, np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), np.cumsum(sizes[0] + sizes[1]))
        for side, (ids, token_ends) in enumerate(((a, ends_a), (b, ends_b))):
            self.firsts[side] = np.concatenate([self.firsts[side], len(self.ids[side]) + np.cumsum(sizes[side]) - sizes[side]])
            self.sizes[side] = np.concatenate([self.sizes[side], sizes[side]])
            group = np.searchsorted(cuts, token_ends) - np.repeat(upto - n_groups, sizes[side])
            self.ids[side] = np.concatenate([self.ids[side], ids.astype(np.int32)])
            self.groups[side] = np.concatenate([self.groups[side], group.astype(np.int32)])
        known = len(self.number)
        self.number.update(zip(new, range(known, known + len(new))))
        self.n_groups, self.fits = np.concatenate([self.n_groups, n_groups]), np.concatenate([self.fits, fits])

    def _written(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The groups of every segment; ``ends`` counts the tokens of both kinds up to a segment's end."""
        words, parts = self.words, self.words.parts
        first_a, first_b = (np.concatenate([np.ones(min(1, len(g)), bool), g[1:] != g[:-1]]) for g in (group_a, group_b))
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + np.where(first_a, words.a_first, words.a_next)
        code[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = b + np.where(first_b, words.b_first, words.b_next)
        flat, upto = [parts[c] for c in code.tolist()], ends.tolist()
        return [b"".join(flat[i:j]) for i, j in zip([0, *upto[:-1]], upto)]

    def together(self, segments: list[str]) -> Alignment | None:
        """The alignment of known segments in a row; None if one of them isn't given back."""
        numbers = [self.number[s] for s in segments]
        at = np.array(numbers, np.int64)
        if not self.fits[at].all():
            return None
        before = np.cumsum(self.n_groups[at]) - self.n_groups[at]
        made = []
        for side in (0, 1):
            sizes = self.sizes[side][at]
            token = np.arange(sizes.sum()) + np.repeat(self.firsts[side][at] - np.cumsum(sizes) + sizes, sizes)
            made.append((self.ids[side][token].astype(np.int64), self.groups[side][token] + np.repeat(before, sizes)))
        written = self.written
        said = b"".join([written[i] for i in numbers])
        return Alignment(made[0][0], made[1][0], made[0][1], made[1][1], int(self.n_groups[at].sum()), said)


def _flat(rows: list[tuple[int, ...]], width: int) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(rows), np.int64, width * len(rows)).reshape(-1, width)


def _byte_places(text: str, size: int) -> np.ndarray:
    """Byte offset of every character, and of the end."""
    if size == len(text):
        return np.arange(size + 1)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])


def _given_back(
    data: bytes, ends: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], decoded: tuple[list[bytes], list[bytes]], lengths: tuple[np.ndarray, np.ndarray]
) -> np.ndarray:
    """For every segment, whether the decoded bytes of both tokenizers are its bytes."""
    fits = np.ones(len(ends), bool)
    starts = np.concatenate([[0], ends[:-1]])
    for size, parts, length in zip(sizes, decoded, lengths):
        laid = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(size)])]
        joined = b"".join(parts)
        if joined != data or (laid[1:] != ends).any():
            for i, (a, b, c, d) in enumerate(zip(laid[:-1].tolist(), laid[1:].tolist(), starts.tolist(), ends.tolist())):
                fits[i] &= joined[a:b] == data[c:d]
    return fits


@functools.lru_cache(maxsize=2)
def known_segments(settings: SpanSettings, whole_texts: bool = False) -> Segments:
    """A worker's store, and another one for texts that have to be encoded whole."""
    return Segments(settings)


def align(texts: list[str | None], settings: SpanSettings = SpanSettings()) -> Iterator[Alignment | None]:
    """Both tokenizations of whole texts, each behind one space, cut into groups; None for a text without tokens.

    A null or empty text has none, and neither has one whose decoded bytes of either tokenizer aren't the space and the text.
    """
    known = known_segments(settings)
    cut = [(_SEGMENT.findall(" " + t) if known.apart else [" " + t]) if t else [] for t in texts]
    known.learn(set().union(*cut))
    for text, segments in zip(texts, cut):
        found = known.together(segments) if segments else None
        if segments and found is None:
            # A segment isn't given back: the whole text decides.
            alone = known_segments(settings, whole_texts=True) if len(segments) > 1 else None
            if alone:
                alone.learn({" " + text})
                found = alone.together([" " + text])
                alone.forget()
        yield found


class GroupText:
    """Ids in decimal behind each of the marks they can follow, in one list."""

    def __init__(self, size_a: int, size_b: int):
        self.a_first, self.a_next, self.b_first, self.b_next = 0, size_a, 2 * size_a, 2 * size_a + size_b
        self.parts = [b"%s%d" % (mark, i) for mark, n in ((b";", size_a), (b",", size_a), (b"|", size_b), (b",", size_b)) for i in range(n)]


@functools.lru_cache(maxsize=2)
def group_text(a: str, b: str) -> GroupText:
    return GroupText(len(encoder_a(a)[1]), len(encoder_b(b)[1]))


def figures(found: Alignment | None) -> tuple[tuple[int, int, int, int, str], np.ndarray, np.ndarray]:
    """Numbers of tokens, groups and links and the hash of the groups; distinct pairs; links of each pair."""
    if found is None:
        return (0, 0, 0, 0, ""), np.empty(0, np.int64), np.empty(0, np.int64)
    pairs, times = found.links()
    said = hashlib.sha256(memoryview(found.written)[1:]).hexdigest()
    return (len(found.a), len(found.b), found.n_groups, int(times.sum()), said), pairs, times


# -- on Spark -------------------------------------------------------------------------------------

COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _document_field(docs: DataFrame, doc_id: str) -> T.StructField:
    return T.StructField("doc_id", docs.schema[doc_id].dataType)


def _schema(first: list[T.StructField], ddl: str) -> T.StructType:
    return T.StructType([*first, *T._parse_datatype_string(ddl).fields])


class _Chunk:
    """Texts of one chunk, and their pairs."""

    def __init__(self):
        self.ids: list[pa.Scalar] = []
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: pa.Scalar, row: tuple, pairs: np.ndarray, times: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.rows.append(row)
        self.pairs.append(pairs)
        self.times.append(times)
        self.held += len(pairs)

    def batch(self, number: int, arrow: pa.Schema) -> pa.RecordBatch:
        """A row per text, which refers to places of pairs, and one more row with the chunk's pairs and their numbers of texts."""
        found, places, counts = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        kind = np.uint16 if len(found) <= 1 << 16 else np.uint32
        ends = np.cumsum([len(p) for p in self.pairs])
        places = np.split(places.astype(kind), ends[:-1])
        times = [None if (t == 1).all() else t.astype(np.uint32 if t.max() < 1 << 32 else np.uint64).tobytes() for t in self.times]
        n = len(self.rows) + 1
        columns = [pa.array([*self.ids, None], arrow.field(0).type), *(pa.array([*c, None], f.type) for c, f in zip(zip(*self.rows), list(arrow)[1:]))]
        columns += [
            pa.array([number] * n, pa.int64()),
            pa.array([p.tobytes() for p in places] + [None], pa.binary()),
            pa.array([*times, None], pa.binary()),
            pa.array([len(found)] * n, pa.int64()),
            pa.array([None] * (n - 1) + [found], pa.list_(pa.int64())),
            pa.array([None] * (n - 1) + [counts], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _chunks(docs: DataFrame, doc_id: str, text: str, settings: SpanSettings) -> DataFrame:
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = _schema([_document_field(docs, doc_id)], f"{COUNTS}, chunk long, places binary, times binary, n_pairs long, pairs array<long>, texts array<long>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk()
        for batch in batches:
            for start, stop in slices(batch.column(1), 1_000_000):
                part = batch.slice(start, stop - start)
                for value, found in zip(part.column(0).to_pylist(), align(part.column(1).to_pylist(), settings)):
                    chunk.add(value, *figures(found))
                    if chunk.held >= settings.chunk_pairs or len(chunk.rows) >= settings.chunk_texts:
                        yield chunk.batch(number, arrow)
                        chunk, number = _Chunk(), number + 1
        if chunk.rows:
            yield chunk.batch(number, arrow)

    return slim.mapInArrow(run, schema)


def align_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: SpanSettings = SpanSettings()) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256`` of every row of ``docs``.

    A link is an occurrence of a token of each tokenizer in one group. A pair's count is the number of rows that hold
    it linked; ``count_sum`` adds the counts of all links, ``n_best`` counts links whose pair has the highest count of its first
    id. Texts that are null, empty, or not given back by either tokenizer have no tokens: zeros, and an empty hash.
    Rows that repeat an id, or have none, are judged each by its own text. Extra columns are left out,
    whatever their names. An empty table gives an empty result.
    """
    workers_find_package(docs.sparkSession)
    written = cut_lineage(_chunks(docs, doc_id, text, settings))
    listed = written.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "texts")).alias("place", "of"))
    placed = listed.select(F.col("chunk").alias("of_chunk"), "place", F.col("of.pairs").alias("pair"), F.col("of.texts").alias("texts"))
    first_id = F.expr(f"pair div {B_SPACE}")
    counts = cut_lineage(placed.groupBy("pair").agg(F.sum("texts").alias("count")).withColumn("a", first_id))
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    ranked = counts.join(best, "a").select(F.col("pair").alias("of_pair"), "count", (F.col("count") == F.col("most")).alias("best"))
    looked = placed.join(ranked, F.col("pair") == F.col("of_pair")).select("of_chunk", "place", "count", "best")
    texts = written.where("pairs IS NULL").select("chunk", "doc_id", *(c.split()[0] for c in COUNTS.split(", ")), "places", "times", "n_pairs")
    schema = _schema([_document_field(docs, doc_id)], "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    arrow = to_arrow_schema(schema)

    def sums(rows: pa.Table, found: pa.Table) -> pa.Table:
        pairs = rows.column("n_pairs")[0].as_py() if len(rows) else 0
        count, is_best = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
        at = found.column("place").to_numpy()
        count[at], is_best[at] = found.column("count").to_numpy(), found.column("best").to_numpy().astype(np.int64)
        kind = np.uint16 if pairs <= 1 << 16 else np.uint32
        n_best, count_sum = [], []
        for places, times in zip(rows.column("places").to_pylist(), rows.column("times").to_pylist()):
            own = np.frombuffer(places, kind)
            each = 1 if times is None else np.frombuffer(times, np.uint32 if len(times) == 4 * len(own) else np.uint64).astype(np.int64)
            n_best.append(int((is_best[own] * each).sum()))
            count_sum.append(int((count[own] * each).sum()))
        made = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table([made.get(f.name, rows.column(f.name) if f.name not in made else None) for f in arrow], schema=arrow)

    out = texts.groupBy("chunk").cogroup(looked.groupBy("of_chunk")).applyInArrow(sums, schema)
    return out.withColumnRenamed("doc_id", doc_id)


def aligned_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: SpanSettings = SpanSettings()) -> DataFrame:
    """(doc_id, start, stop, a_ids, b_ids): every group as a row, with its byte range in the text behind one space.

    Texts without tokens give no row; otherwise as in :func:`align_tokens`.
    """
    workers_find_package(docs.sparkSession)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = _schema([_document_field(docs, doc_id)], "start long, stop long, a_ids array<int>, b_ids array<int>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = known_segments(settings).lengths_a
        for batch in batches:
            for start, stop in slices(batch.column(1), 1_000_000):
                part = batch.slice(start, stop - start)
                for value, found in zip(part.column(0).to_pylist(), align(part.column(1).to_pylist(), settings)):
                    if found is None:
                        continue
                    sizes = np.bincount(found.group_a, lengths[found.a], found.n_groups).astype(np.int64)
                    a, b = (
                        np.split(ids, np.cumsum(np.bincount(group, minlength=found.n_groups))[:-1])
                        for ids, group in ((found.a, found.group_a), (found.b, found.group_b))
                    )
                    columns = [[value] * found.n_groups, np.cumsum(sizes) - sizes, np.cumsum(sizes), a, b]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return slim.mapInArrow(run, schema).withColumnRenamed("doc_id", doc_id)
