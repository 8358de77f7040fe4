"""Packing by lexical retrieval: windows are filled with a seed document and its BM25 neighbours.

1. Every document is encoded once, with the closing id. Windows it fills alone are cut off at once; the rest,
   less than a window, is a unit still to be placed. Units are written to the shared folder.
2. Document frequencies of all token ids and the mean length are taken over all units; frequencies are counted per task
   where the units are made, and summed.
3. Units are dealt into shards of a bounded number of tokens. Each shard has an inverted index from token
   ids to its units, with BM25 weights from the corpus-wide statistics. A seed asks the index of its own shard
   for units not yet used, by all of its terms; they fill its window in order of score, the last one is cut to
   fit, and what is left of it seeds the next window. Where no unit shares a term, the longest unused
   units fill the window. Units of other shards are never asked: with more shards a smaller share of a
   seed's best neighbours can be found.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import slices, workers_find_package
from matchspark.llm.tokens import IDS, encode
from matchspark.session import cut_lineage

WINDOW = 2048
END_ID = 1
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: A term of more than one in so many units of a shard has a row of weights for all of them.
DENSE = 4
PIECE_NAMES = [c.split()[0] for c in PIECE.split(", ")]
UNIT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, ids binary, "
    "terms array<int>, counts array<long>"
)
#: Share of the units an index still lists, below which the used ones are taken out.
COMPACT = 0.8


@dataclass(frozen=True)
class Packing:
    """Window and closing id; tokens per shard; BM25's constants; terms of a seed that are looked up (None: all)."""

    window: int = WINDOW
    end_id: int = END_ID
    shard_tokens: int = 4_000_000
    k1: float = 1.2
    b: float = 0.75
    query_terms: int | None = None


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded_units(docs: DataFrame, doc_id: str, text: str, packing: Packing) -> DataFrame:
    """Full windows of one document (ids null) and the units left to place; sequence_id numbers both.

    One more row per task, with ``terms`` and ``counts``, tells in how many of the task's units each id occurs.
    """
    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    window = packing.window
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
         ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("ids", pa.binary()),
         ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Even sequence numbers, of this task: full windows. Odd ones: windows of shards.
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        held = 0
        seen = np.zeros(IDS, np.int64)

        def flush():
            nonlocal rows, held
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
            rows, held = [], 0
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for start, stop in slices(batch.column(1), 8_000_000):
                part = batch.slice(start, stop - start)
                for value, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(encode(t) if t else np.empty(0, np.uint16), np.uint16(packing.end_id))
                    full = len(ids) // window * window
                    for at in range(0, full, window):
                        rows.append((value, at, window, crc(ids[at : at + window]), len(ids), sequence * 2, None, None, None))
                        sequence += 1
                    if full < len(ids):
                        unit = ids[full:]
                        seen[np.unique(unit)] += 1
                        rows.append((value, full, len(unit), None, len(ids), sequence * 2, unit.tobytes(), None, None))
                        sequence += 1
                    held += len(ids)
                    if held > 2_000_000:
                        yield flush()
        terms = np.flatnonzero(seen)
        if len(terms):
            rows.append((None,) * 7 + (terms, seen[terms]))
        if rows:
            yield flush()

    return slim.mapInArrow(run, UNIT)


def document_frequencies(written: DataFrame) -> np.ndarray:
    """Number of units that hold each token id: the sum of the tasks' counts; one number per id comes back."""
    listed = written.where("terms IS NOT NULL").select(F.inline(F.arrays_zip("terms", "counts")))
    out = np.zeros(IDS, np.int64)
    for r in listed.groupBy("terms").agg(F.sum("counts").alias("n")).collect():
        out[r.terms] = r.n
    return out


class Index:
    """Inverted index of a shard: token id to (unit, BM25 weight), and the best terms of every unit."""

    def __init__(self, units: list[np.ndarray], frequencies: np.ndarray, n_units: int, mean_length: float, packing: Packing):
        idf = np.log1p((n_units - frequencies + 0.5) / (frequencies + 0.5)).clip(min=0).astype(np.float32)
        terms, weights, counts, self.asks = [], [], [], []
        for ids in units:
            term, tf = np.unique(ids, return_counts=True)
            norm = packing.k1 * (1 - packing.b + packing.b * len(ids) / mean_length)
            weight = (idf[term] * tf * (packing.k1 + 1) / (tf + norm)).astype(np.float32)
            terms.append(term)
            weights.append(weight)
            counts.append(len(term))
            most = len(term) if packing.query_terms is None else min(len(term), packing.query_terms)
            self.asks.append(term[np.argpartition(-weight, most - 1)[:most]])
        owner = np.repeat(np.arange(len(units), dtype=np.int32), counts)
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self.units, self.weights = owner[order].astype(np.int64), np.concatenate(weights)[order].astype(np.float64)
        self.ends = np.searchsorted(term[order], np.arange(IDS + 1))
        self.size = len(units)
        self.listed = np.arange(self.size)
        # Terms of over a quarter of the units: a row of weights for all units is added faster than a list.
        common = np.flatnonzero(np.diff(self.ends) > self.size // DENSE)
        self.row = np.full(IDS, -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.size), np.float32)
        for k, t in enumerate(common.tolist()):
            self.rows[k, self.units[self.ends[t] : self.ends[t + 1]]] = self.weights[self.ends[t] : self.ends[t + 1]]

    def keep(self, free: np.ndarray) -> None:
        """List free units only; no score of a free unit changes."""
        stays = free[self.listed]
        place = np.cumsum(stays) - 1
        held = stays[self.units]
        self.ends = np.concatenate([[0], np.cumsum(held)])[self.ends]
        self.units, self.weights = place[self.units[held]], self.weights[held]
        self.rows, self.listed = self.rows[:, stays], self.listed[stays]

    def scores(self, unit: int) -> np.ndarray:
        """BM25 of every listed unit for the unit's query."""
        asked = self.asks[unit]
        row = self.row[asked]
        wanted = np.zeros(len(self.rows), np.float32)
        wanted[row[row >= 0]] = 1
        score = wanted @ self.rows
        rare = asked[row < 0].astype(np.int64)
        found = [slice(a, b) for a, b in zip(self.ends[rare].tolist(), self.ends[rare + 1].tolist()) if a < b]
        if not found:
            return score
        who = np.concatenate([self.units[s] for s in found])
        return score + np.bincount(who, np.concatenate([self.weights[s] for s in found]), len(self.listed))

    def neighbours(self, unit: int, free: np.ndarray, first: int = 64) -> Iterator[int]:
        """Free units that share a term with the unit's query, best first; units of one score in their order."""
        score = self.scores(unit)
        hit = np.flatnonzero((score > 0) & free[self.listed])
        if len(hit) > first:
            near = np.argpartition(-score[hit], first)[:first]
            best = hit[near]
            yield from self.listed[best[np.lexsort((best, -score[best]))]].tolist()
            hit = np.delete(hit, near)
        yield from self.listed[hit[np.lexsort((hit, -score[hit]))]].tolist()


def pack_shard(units: list[np.ndarray], index: Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """(unit, start in unit, length, sequence, offset) of all pieces; only the last window may have room left."""
    free = np.ones(len(units), bool)
    by_length = np.argsort([-len(u) for u in units], kind="stable").tolist()
    rest = 0  # of by_length, what may still be free
    pieces = []
    seed, at, sequence = -1, 0, 0
    listed = len(units)
    while True:
        if seed < 0:
            while rest < len(by_length) and not free[by_length[rest]]:
                rest += 1
            if rest == len(by_length):
                return pieces
            seed, at = by_length[rest], 0
            free[seed] = False
        filled = len(units[seed]) - at
        pieces.append((seed, at, filled, sequence, 0))
        cut = -1
        if filled < window:
            if (left := int(free.sum())) < COMPACT * listed:
                index.keep(free)
                listed = left
            for unit in index.neighbours(seed, free):
                take = min(window - filled, len(units[unit]))
                pieces.append((unit, 0, take, sequence, filled))
                free[unit] = False
                filled += take
                if take < len(units[unit]):
                    cut, at = unit, take
                if filled == window:
                    break
            while filled < window:
                while rest < len(by_length) and not free[by_length[rest]]:
                    rest += 1
                if rest == len(by_length):
                    break
                unit = by_length[rest]
                take = min(window - filled, len(units[unit]))
                pieces.append((unit, 0, take, sequence, filled))
                free[unit] = False
                filled += take
                if take < len(units[unit]):
                    cut, at = unit, take
        seed = cut
        sequence += 1


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", packing: Packing = Packing()) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text and the closing id; each of these ids lies in exactly one piece. A
    sequence has at most ``window`` ids and its offsets have no gaps; besides the last one of each shard, all
    are full. A null or empty text is its closing id alone. Rows that repeat an id are packed each for itself;
    a null id stays null. Extra columns are left out, whatever their names. An empty table gives no piece.
    """
    workers_find_package(docs.sparkSession)
    written = cut_lineage(encoded_units(docs, doc_id, text, packing))
    units = written.where("ids IS NOT NULL")
    n_units, tokens = units.agg(F.count("*"), F.sum("length")).first()
    full = written.where("ids IS NULL AND terms IS NULL").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset")
    )
    if not n_units:
        return full
    frequencies = document_frequencies(written)
    mean_length = tokens / n_units
    shards = -(-tokens // packing.shard_tokens)
    sent = docs.sparkSession.sparkContext.broadcast(frequencies)

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("sequence_id")
        ids = [np.frombuffer(b.as_buffer(), np.uint16) for b in rows.column("ids")]
        index = Index(ids, sent.value, n_units, mean_length, packing)
        unit, at, length, sequence, offset = np.array(pack_shard(ids, index, packing.window), np.int64).T
        of = rows.take(pa.array(unit))
        start = of.column("start").to_numpy() + at
        sums = [crc(ids[u][a : a + n]) for u, a, n in zip(unit, at, length)]
        number = (key[0].as_py() << 40 | sequence) * 2 + 1
        columns = [of.column("doc_id"), start, length, sums, of.column("doc_tokens"), number, offset]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, pa.int64()) for c in columns], PIECE_NAMES)

    # Dealt by number, not by content: copies of one document spread over all shards.
    shard = F.pmod(F.xxhash64("sequence_id"), F.lit(shards).cast("long")).alias("shard")
    dealt = units.select("doc_id", "start", "doc_tokens", "sequence_id", "ids", shard)
    return full.union(dealt.groupBy("shard").applyInArrow(pack, PIECE))
