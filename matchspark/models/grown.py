"""Forests whose trees are too many or too large for one process, grown and kept as tables.

Spark ML counts every node of a tree in full histograms in every task and keeps the model on the driver, both of which
end with trees as deep as the rows allow. Here the top of each tree is grown level by level from summed histograms, until
a node has at most ``ROWS_A_GROUP`` rows (fewer if they are wide). The rows of such a node meet in one group, which grows the rest of that branch.
Branches stay in a table; rows to be scored meet them by the same key. So no task, nor the driver, holds a whole tree or table.

The trees follow Spark ML's rules: Poisson draws of rows, ``max_bins`` quantile bins, Gini gain over the features drawn for the
node, ``min_leaf`` counting rows as drawn, and two leaves of one parent that predict the same class become one (inside a
branch). All draws are hashes of seed, tree, node and row number, so a repeated task draws the same.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchspark.functions.expressions import top_class
from matchspark.functions.text import tick
from matchspark.models.nested import Cut, stands_for
from matchspark.operators.evaluate import CLASSES, PROBABILITIES
from matchspark.session import cut_lineage, scratch_path, workers_find_package

ROWS_A_GROUP, LEAST_A_GROUP, BYTES_A_GROUP = 131_072, 16_384, 2**24
VOTES_A_BLOCK, MOST_A_BLOCK = 2**25, 4096
ROWS_A_FILE, VISITS_A_TASK = 100_000, 2_000_000
ROWS_A_BLOCK = 128
# of a pass over nodes, so that its arrays stay in a core's cache; levels between two sortings of the rows; rows of a node that is split by sorting
CELLS_A_PASS, ROWS_A_PASS, LEVELS_IN_PLACE, FEW_ROWS = 2**16, 2**14, 3, 16
TREES_A_PASS = 50
SWAPPED_A_BLOCK, SWAPPED_AT_ONCE = 512, 1024
C = len(CLASSES)
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])
BRANCH = "sub bigint, feature array<int>, bin array<int>, left array<int>, raw array<bigint>, stats array<double>, importance array<double>"


def mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit numbers."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(rows: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """How often each tree draws each row, rows x trees."""
    return times_of(mixed(mixed(rows.astype(np.uint64))[:, None] ^ tree_hashes(trees, seed)[None, :]))


def tree_hashes(trees: np.ndarray, seed: int) -> np.ndarray:
    return mixed(mixed(trees.astype(np.uint64)) + np.uint64(seed))


# a draw by its first 12 bits, and those it isn't settled by
_FIRST = np.searchsorted(POISSON, np.arange(4097) / 4096, side="right")
_DRAW, _OPEN = _FIRST[:-1].astype(np.uint8), _FIRST[:-1] != np.append(_FIRST[1:-1], -1)


def times_of(hashes: np.ndarray) -> np.ndarray:
    """The Poisson draw that each hash stands for."""
    first = (hashes >> np.uint64(52)).astype(np.int64)
    times = _DRAW[first].astype(np.int64)
    rest = _OPEN[first]
    times[rest] = np.searchsorted(POISSON, (hashes[rest] >> np.uint64(11)) * 2.0**-53, side="right")
    return times


def features_of(hashes: np.ndarray, n_features: int, k: int) -> np.ndarray:
    """The features drawn for each node, in order."""
    if k >= n_features:
        return np.tile(np.arange(n_features), (len(hashes), 1))
    # the place takes the lowest bits of a rank
    places = np.arange(n_features, dtype=np.uint64)
    low = np.uint64((1 << (n_features - 1).bit_length()) - 1)
    ranks = (mixed(hashes[:, None] ^ mixed(places)[None, :]) & ~low) | places
    return np.sort((np.partition(ranks, k - 1, axis=1)[:, :k] & low).astype(np.int64), axis=1)


def child_hash(hashes: np.ndarray, side: int) -> np.ndarray:
    return mixed(hashes * np.uint64(2) + np.uint64(side))


def subset_size(strategy: str, n: int) -> int:
    """Number of features tried at a node, as Spark ML counts them."""
    named = {"all": n, "auto": math.ceil(math.sqrt(n)), "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "onethird": math.ceil(n / 3)}
    if strategy in named:
        return named[strategy]
    return min(n, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * n)


def best_splits(sums: np.ndarray, raws: np.ndarray | None, min_leaf: int):
    """Best splits of nodes from sums (classes, m, k, bins) and rows as drawn (m, k, bins) of their bins, which may be missing for ``min_leaf`` 1.

    Per node: place among its features, last bin of the left side, gain (0: none), and both sides' sums.
    """
    left = sums.cumsum(3)
    _, m, _, bins = sums.shape
    total = left[:, :, :1, -1:]
    # all on the left is no split: its gain is 0, but for last bits
    gain = _gains(left, total)
    if raws is not None:
        raws = raws.cumsum(2)
        gain[(raws < min_leaf) | (raws > raws[:, :1, -1:] - min_leaf)] = 0.0
    flat, node = gain.reshape(m, -1), np.arange(m)
    at = flat.argmax(1)
    j, b = np.divmod(at, bins)
    best = flat[node, at]
    ls = left[:, node, j, b].T
    return j, b, np.where(best > 1e-12, best, 0.0), np.stack([ls, total[:, :, 0, 0].T - ls], 1)


def _gains(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Gini gain, as a share of the node's weight, of splits with these sums of each class on the left and in the whole node."""

    def squares(s: np.ndarray) -> np.ndarray:
        w, q, one = s[0] + s[1], s[0] * s[0], np.empty(s.shape[1:])
        for v in s[2:]:
            w += v
        for v in s[1:]:
            q += np.multiply(v, v, out=one)
        w[w <= 0] = 1.0
        q /= w
        return q

    whole = sum(total[1:], total[0])
    gain = squares(left)
    gain += squares(total - left)
    gain -= squares(total)
    gain /= np.where(whole > 0, whole, 1.0)
    return gain


def histograms(columns: np.ndarray, rows: np.ndarray, slot: np.ndarray, chosen: np.ndarray, label, weight, raw, bins: int):
    """Weighted sums (classes, m, k, bins) of the rows' bins by node and feature chosen for it, and rows as drawn if ``raw`` is there. ``columns`` are
    the bins, a line per feature."""
    m, k = chosen.shape
    size = m * k * bins
    values = columns.ravel().take((chosen * columns.shape[1]).T.take(slot, 1) + rows)
    cell = slot * (k * bins) + (np.arange(k) * bins)[:, None] + values
    # of no rows, bincount makes whole numbers
    raws = None if raw is None else np.bincount(cell.ravel(), np.tile(raw[rows], k), size).astype(float, copy=False).reshape(m, k, bins)
    cell += label[rows] * size
    return np.bincount(cell.ravel(), np.tile(weight[rows], k), C * size).astype(float, copy=False).reshape(C, m, k, bins), raws


def _splits_in_order(columns: np.ndarray, rows: np.ndarray, first: np.ndarray, size: np.ndarray, chosen: np.ndarray, label, weight, raw, min_leaf: int, whole: bool):
    """The best splits of nodes of few rows, which lie in ``rows`` from ``first`` on: their bins are sorted, since most of a histogram would be empty."""
    m, k = chosen.shape
    width = int(size.max())
    there = np.arange(width) < size[:, None]
    mine = rows[np.where(there, first[:, None] + np.arange(width), first[:, None])]
    key = columns.ravel().take((chosen * columns.shape[1])[:, :, None] + mine[:, None, :]).astype(np.uint16)
    key <<= 8
    key |= np.arange(width, dtype=np.uint16)
    # the padding comes last, and stands for a row of no weight
    pad = ~there[:, None, :]
    np.copyto(key, np.uint16(0xFFFF), where=pad)
    key.sort(axis=2)
    order = (key & 0xFF).astype(np.int64)
    key >>= 8
    np.copyto(order, width, where=pad)
    order += (np.arange(m) * (width + 1))[:, None, None]
    # the order goes down from here on
    key, order = np.ascontiguousarray(key.reshape(-1, width).T), np.ascontiguousarray(order.reshape(-1, width).T)
    last = np.ones(key.shape, bool)
    np.not_equal(key[:-1], key[1:], out=last[:-1])

    def running(values: np.ndarray, by_bin: bool = False) -> np.ndarray:
        """Sums along the order. With ``by_bin`` rows of a bin are summed first, as in a histogram, where the last bits hang on it."""
        s = values.ravel().take(order)
        if by_bin:
            for i in range(1, width):
                s[i] += np.where(last[i - 1], 0.0, s[i - 1])
            s[~last] = 0.0
        for i in range(1, width):
            s[i] += s[i - 1]
        return s

    w, l = np.zeros((m, width + 1)), np.full((m, width + 1), -1)
    w[:, :-1][there], l[:, :-1][there] = weight[mine[there]], label[mine[there]]
    left = np.stack([running(np.where(l == c, w, 0.0), not whole) for c in range(C)]).reshape(C, width, m, k)
    total = left[:, -1:, :, :1]
    gain = _gains(left, total)
    wrong = ~last.reshape(gain.shape)
    if min_leaf > 1:
        w[:, :-1][there] = raw[mine[there]]
        s = running(w).reshape(gain.shape)
        wrong |= (s < min_leaf) | (s > s[-1:, :, :1] - min_leaf)
    gain[wrong] = 0.0
    node = np.arange(m)
    j = gain.max(0).argmax(1)
    at = gain[:, node, j].argmax(0)
    best, ls = gain[at, node, j], left[:, at, node, j].T
    return j, key.reshape(gain.shape)[at, node, j].astype(np.int64), np.where(best > 1e-12, best, 0.0), np.stack([ls, total[:, 0, :, 0].T - ls], 1)


def grow_branch(columns: np.ndarray, label, weight, raw, start: int, depth: int, rule: "Rule") -> dict[str, np.ndarray]:
    """A branch from its rows, whose bins are ``columns``, a line per feature: arrays with one entry per node, root first. A node's right child
    follows its left one.

    Nodes of a level are split together, those of few rows by sorting, the others by histograms.
    """
    made = {c: [] for c in ("feature", "bin", "left", "raw", "stats", "gain")}
    rows, slot, hashes = np.arange(len(label)), np.zeros(len(label), np.int64), np.array([start], np.uint64)
    stats, raws = np.bincount(label, weight, C)[None, :], np.array([raw.sum()])
    born, since, whole = 1, 0, not (weight % 1).any()
    while len(hashes):
        m = len(hashes)
        feature, split, left, gains = np.full(m, -1), np.zeros(m, np.int64), np.full(m, -1), np.zeros(m)
        sides = np.zeros((m, 2, C))
        classes = ((stats if whole else np.bincount(slot * C + label[rows], minlength=m * C).reshape(m, C)) > 0).sum(1)
        tried = np.flatnonzero((classes > 1) & (raws >= max(2 * rule.min_leaf, rule.min_split)) & (depth < rule.max_depth))
        # slots count the nodes that are tried, the smallest first, until all splits are known
        tried = tried[np.argsort(np.bincount(slot, minlength=m)[tried], kind="stable")]
        place = np.full(m, -1)
        place[tried] = np.arange(len(tried))
        slot = place[slot]
        alive = np.flatnonzero(slot >= 0)
        rows, slot = rows[alive], slot[alive]
        order = np.argsort(slot.astype(np.uint16) if len(tried) < 2**16 else slot, kind="stable")
        rows, slot = rows[order], slot[order]
        since += 1
        if since == LEVELS_IN_PLACE:
            # rows of a node next to each other, and without those that are done
            columns, label, weight, raw = columns.take(rows, 1), label[rows], weight[rows], raw[rows]
            rows, since = np.arange(len(rows)), 0
        size = np.bincount(slot, minlength=len(tried))
        ends = np.cumsum(size)
        chosen = features_of(hashes[tried], rule.n_features, rule.k)
        low = 0
        while low < len(tried):
            few = size[low] <= FEW_ROWS
            if few:
                width = 1 << int(size[low] - 1).bit_length()
                high = min(int(np.searchsorted(size, width, side="right")), low + max(1, CELLS_A_PASS // (rule.k * width)))
            else:
                by_rows = int(np.searchsorted(ends, ends[low] - size[low] + ROWS_A_PASS, side="right"))
                high = max(low + 1, min(by_rows, low + CELLS_A_PASS // (rule.k * rule.bins)))
            first, some = ends[low:high] - size[low:high], chosen[low:high]
            if few:
                j, at, gain, both = _splits_in_order(columns, rows, first, size[low:high], some, label, weight, raw, rule.min_leaf, whole)
            else:
                r, s = rows[first[0] : ends[high - 1]], slot[first[0] : ends[high - 1]] - low
                j, at, gain, both = best_splits(*histograms(columns, r, s, some, label, weight, raw if rule.min_leaf > 1 else None, rule.bins), rule.min_leaf)
            good = np.flatnonzero(gain > 0)
            nodes = tried[low:high][good]
            feature[nodes], split[nodes], gains[nodes], sides[nodes] = some[good, j[good]], at[good], gain[good], both[good]
            low = high
        inner = np.flatnonzero(feature >= 0)
        left[inner] = born + 2 * np.arange(len(inner))
        for c, v in (("feature", feature), ("bin", split), ("left", left), ("raw", raws), ("stats", stats), ("gain", gains)):
            made[c].append(v)
        born += 2 * len(inner)
        place = np.full(m, -1)
        place[inner] = 2 * np.arange(len(inner))
        slot = tried[slot]
        stay = np.flatnonzero(place[slot] >= 0)
        rows, slot = rows[stay], slot[stay]
        slot = place[slot] + (columns.ravel().take(feature[slot] * columns.shape[1] + rows) > split[slot])
        hashes = np.stack([child_hash(hashes[inner], 0), child_hash(hashes[inner], 1)], 1).ravel()
        stats, raws = sides[inner].reshape(-1, C), np.bincount(slot, raw[rows], 2 * len(inner))
        depth += 1
    return merged_leaves({c: np.concatenate(v) for c, v in made.items()})


def merged_leaves(b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    left, right = b["left"], np.where(b["left"] >= 0, b["left"] + 1, -1)
    stands = stands_for(b["raw"], b["stats"].argmax(1), left, right, Cut())
    kept = np.flatnonzero(stands == np.arange(len(stands)))
    place = np.full(len(stands), -1)
    place[kept] = np.arange(len(kept))
    inner = (left[kept] >= 0) & (stands[left[kept]] == left[kept])
    out = {c: v[kept] for c, v in b.items()}
    out["left"] = np.where(inner, place[left[kept]], -1)
    out["feature"], out["gain"] = np.where(inner, out["feature"], -1), np.where(inner, out["gain"], 0.0)
    return out


@dataclass(frozen=True)
class Words:
    """Where each feature's bin lies in a row of 16-bit words, in no more bits than its number of bins needs."""

    word: np.ndarray
    shift: np.ndarray
    bits: np.ndarray
    n: int

    @staticmethod
    def of(limits: Sequence[np.ndarray]) -> "Words":
        bits, free = np.array([len(v).bit_length() for v in limits], np.int64), []
        word, shift = np.zeros(len(bits), np.int64), np.zeros(len(bits), np.uint16)
        for f in np.argsort(-bits, kind="stable").tolist():
            at = next((i for i, room in enumerate(free) if room >= bits[f]), len(free))
            if at == len(free):
                free.append(16)
            word[f], shift[f] = at, 16 - free[at]
            free[at] -= bits[f]
        return Words(word, shift, bits, max(len(free), 1))

    def pack(self, columns: Sequence[np.ndarray], n_rows: int) -> np.ndarray:
        """Rows of words from bins, a line per feature."""
        out = np.zeros((self.n, n_rows), np.uint16)
        for f, values in enumerate(columns):
            out[self.word[f]] |= values.astype(np.uint16) << self.shift[f]
        return np.ascontiguousarray(out.T)

    def columns(self, rows: np.ndarray) -> np.ndarray:
        """Bins, a line per feature, of rows of words."""
        words, out = np.ascontiguousarray(rows.T), np.empty((len(self.bits), len(rows)), np.uint8)
        for f, bits in enumerate(self.bits.tolist()):
            out[f] = (words[self.word[f]] >> self.shift[f]) & np.uint16((1 << bits) - 1)
        return out


@dataclass(frozen=True)
class Rule:
    """What growing a node needs to know."""

    n_features: int
    k: int
    bins: int
    min_leaf: int
    min_split: int
    max_depth: int


@dataclass
class Tops:
    """The upper nodes of all trees; the first are the roots. ``ended`` are leaves, other nodes without a split begin a branch."""

    n_trees: int
    feature: list[int]
    bin: list[int]
    left: list[int]
    parent: list[int]
    depth: list[int]
    tree: list[int]
    raw: list[float]
    gain: list[float]
    stats: list[list[float]]
    hashes: list[int]
    ended: list[bool]

    @staticmethod
    def of(n_trees: int, seed: int) -> "Tops":
        roots = mixed(np.arange(n_trees, dtype=np.uint64) ^ mixed(np.array([seed + 1], np.uint64))).tolist()
        same = lambda v: [v] * n_trees
        return Tops(n_trees, same(-1), same(0), same(-1), same(-1), same(0), list(range(n_trees)), same(0.0), same(0.0), [[0.0] * C for _ in roots], roots, same(False))

    def add(self, parent: int, side: int, stats, raw: float) -> int:
        values = {
            "feature": -1, "bin": 0, "left": -1, "parent": parent, "depth": self.depth[parent] + 1, "tree": self.tree[parent], "raw": raw, "gain": 0.0,
            "stats": list(stats), "hashes": int(child_hash(np.array([self.hashes[parent]], np.uint64), side)[0]), "ended": False,
        }
        for name, value in values.items():
            getattr(self, name).append(value)
        return len(self.left) - 1

    def arrays(self) -> "TopArrays":
        return TopArrays(*[np.array(getattr(self, c)) for c in ("feature", "bin", "left", "tree")], np.array(self.ended, bool))


@dataclass
class TopArrays:
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    tree: np.ndarray
    ended: np.ndarray

    def ends(self, columns: np.ndarray, rows: np.ndarray, tree: int) -> Iterator[tuple[int, np.ndarray]]:
        """The nodes where rows leave the top of a tree, and their rows in order. ``columns`` are bins, a line per feature."""
        waiting = [(tree, rows)]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            left = int(self.left[node])
            if left < 0:
                yield node, rows
                continue
            right = columns[self.feature[node]].take(rows) > self.bin[node]
            waiting += [(left + 1, rows[right]), (left, rows[~right])]


def matrix(column: pa.ChunkedArray | pa.Array, width: int, dtype=np.uint8) -> np.ndarray:
    """Rows of bytes as a matrix. All rows have ``width`` numbers."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    found = []
    for part in parts:
        if len(part):
            starts = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1]
            if starts[0] < starts[-1]:
                found.append(np.frombuffer(part.buffers()[2], np.uint8)[starts[0] : starts[-1]])
    return (np.concatenate(found) if found else np.zeros(0, np.uint8)).view(dtype).reshape(-1, width)


def as_bytes(m: np.ndarray) -> pa.Array:
    m = np.ascontiguousarray(m)
    starts = np.arange(len(m) + 1, dtype=np.int32) * np.int32(m.shape[1] * m.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(starts), pa.py_buffer(m)])


def packed(keys: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Each key once, and its records as one row of bytes, so that a shuffle moves few long rows."""
    order = np.argsort(keys, kind="stable")
    found, starts = np.unique(keys[order], return_index=True)
    ends = (np.append(starts, len(keys)) * records.itemsize).astype(np.int32)
    return found, pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(ends), pa.py_buffer(records[order].view(np.uint8))])


def blobs(records: np.ndarray, sizes: Sequence[int]) -> pa.Array:
    """So many records each as one row of bytes."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * records.itemsize
    if ends[-1] >= 2**31:
        raise ValueError("more than 2 GB in a batch")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(records).view(np.uint8))])


def unpacked(column: pa.ChunkedArray | pa.Array, kind: np.dtype) -> np.ndarray:
    return matrix(column, 1, kind).ravel()


def rows_a_group(n_features: int) -> int:
    return min(ROWS_A_GROUP, max(LEAST_A_GROUP, BYTES_A_GROUP // max(n_features, 1)))


def trees_a_pass(n_features: int) -> int:
    """So many trees that a batch of 10 000 rows, once for each, stays below 256 MB."""
    return max(1, min(TREES_A_PASS, 2**28 // (10_000 * (n_features + 32))))


def thresholds(rows: DataFrame, n_features: int, bins: int) -> list[np.ndarray]:
    """Upper limits of all bins but the last: between all values where they are few, else at quantiles of all rows."""
    values = rows.select(F.posexplode(vector_to_array("features")).alias("place", "value"))
    found = values.groupBy("place").agg(
        F.percentile_approx("value", [i / bins for i in range(1, bins)], 10_000).alias("cuts"), F.approx_count_distinct("value").alias("n")
    ).collect()
    cuts = {r["place"]: sorted(set(r["cuts"])) for r in found}
    few = [r["place"] for r in found if r["n"] <= 1.3 * bins]
    if few:
        for r in values.where(F.col("place").isin(few)).groupBy("place").agg(F.sort_array(F.collect_set("value")).alias("all")).collect():
            if len(r["all"]) <= bins:
                cuts[r["place"]] = [(a + b) / 2 for a, b in zip(r["all"], r["all"][1:])]
    return [np.array(cuts.get(i, []), float) for i in range(n_features)]


def binned(rows: DataFrame, limits: list[np.ndarray], keep: Sequence[str], values: Column | None = None) -> DataFrame:
    """``keep`` and the bins of each row's features, or of the array ``values``, as :class:`Words`."""
    words = Words.of(limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            made = words.pack([np.searchsorted(cut, values[:, i], side="left") for i, cut in enumerate(limits)], batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], as_bytes(made)], [*keep, "bins"])

    picked = rows.select(*[tick(c) for c in keep], (vector_to_array("features") if values is None else values).alias("_x"))
    schema = picked.select(*[tick(c) for c in keep], F.lit(b"").alias("bins")).schema
    return picked.mapInArrow(run, schema)


def larger(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[pa.Table]:
    """Tables of many batches, so that a tree's top has rows enough to part; their bins take ``BYTES_A_GROUP`` at most, or one batch."""
    most, held, n = max(1, BYTES_A_GROUP // max(n_features, 1)), [], 0
    for batch in batches:
        if held and n + batch.num_rows > most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
        held.append(batch)
        n += batch.num_rows
    if n:
        yield pa.Table.from_batches(held)


def _numbers(batch: pa.RecordBatch | pa.Table, *names: str) -> list[np.ndarray]:
    return [np.asarray(batch.column(c)) for c in names]


def _split_level(rows: DataFrame, tops: Tops, nodes: list[int], rule: Rule, seed: int, words: Words) -> list:
    """The best split of each of the ``nodes``, over all rows."""
    arrays, slots = tops.arrays(), np.full(len(tops.left), -1)
    slots[nodes] = np.arange(len(nodes))
    chosen = features_of(np.array(tops.hashes, np.uint64)[nodes], rule.n_features, rule.k)
    trees = np.unique(arrays.tree[nodes])
    starts = tree_hashes(trees, seed)
    m, p = len(nodes), rule.n_features

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = raws = None
        for table in larger(batches, p):
            columns = words.columns(matrix(table.column("bins"), words.n, np.uint16))
            ids, label, weight = _numbers(table, "_row", "label", "weight")
            ids, label = mixed(ids.astype(np.uint64)), label.astype(np.int64)
            if sums is None:
                sums, raws = np.zeros((m, C, rule.k, rule.bins)), np.zeros((m, rule.k, rule.bins))
            for tree, start in zip(trees.tolist(), starts):
                times = times_of(mixed(ids ^ start))
                weights = weight * times
                for node, r in arrays.ends(columns, np.flatnonzero(times), tree):
                    if slots[node] >= 0:
                        at = slots[node]
                        found = histograms(columns, r, np.zeros(len(r), np.int64), chosen[at : at + 1], label, weights, times, rule.bins)
                        sums[at] += found[0][:, 0]
                        raws[at] += found[1][0]
        if sums is not None:
            seen = np.flatnonzero(raws.any((1, 2)))
            yield pa.RecordBatch.from_arrays([pa.array(seen), as_bytes(sums[seen].reshape(len(seen), -1)), as_bytes(raws[seen].reshape(len(seen), -1))], ["slot", "sums", "raws"])

    def choose(key: tuple, parts: pa.Table) -> pa.Table:
        cells = rule.k * rule.bins
        sums = matrix(parts.column("sums"), cells * C, np.float64).sum(0).reshape(C, 1, rule.k, rule.bins)
        raws = matrix(parts.column("raws"), cells, np.float64).sum(0).reshape(1, rule.k, rule.bins)
        j, b, gain, both = (v[0] for v in best_splits(sums, raws, rule.min_leaf))
        at, rl = key[0].as_py(), float(raws[0, j, : b + 1].sum())
        values = [at, int(chosen[at, j]), int(b), float(gain), both[0].tolist(), both[1].tolist(), rl, float(raws[0, j].sum()) - rl]
        return pa.table([pa.array([v]) for v in values], ["slot", "feature", "bin", "gain", "ls", "rs", "lr", "rr"])

    parts = rows.mapInArrow(count, "slot bigint, sums binary, raws binary")
    ddl = "slot bigint, feature bigint, bin bigint, gain double, ls array<double>, rs array<double>, lr double, rr double"
    return parts.groupBy("slot").applyInArrow(choose, ddl).collect()


def _grow_tops(rows: DataFrame, n_rows: int, n_trees: int, rule: Rule, seed: int, memory_mb: int, words: Words) -> Tops:
    tops = Tops.of(n_trees, seed)
    active = list(range(n_trees)) if n_rows > rows_a_group(rule.n_features) and rule.max_depth > 0 else []
    at_once = max(1, memory_mb * 2**20 // 8 // (rule.k * rule.bins * (C + 1) * 8))
    while active:
        later = []
        for low in range(0, len(active), at_once):
            nodes = active[low : low + at_once]
            for r in _split_level(rows, tops, nodes, rule, seed, words):
                node, both = nodes[r["slot"]], [r["ls"], r["rs"]]
                tops.stats[node], tops.raw[node] = [a + b for a, b in zip(*both)], r["lr"] + r["rr"]
                if not r["gain"] > 0:
                    tops.ended[node] = True
                    continue
                tops.feature[node], tops.bin[node], tops.gain[node] = r["feature"], r["bin"], r["gain"]
                for side, (stats, raw) in enumerate(zip(both, (r["lr"], r["rr"]))):
                    child = tops.add(node, side, stats, raw)
                    if side == 0:
                        tops.left[node] = child
                    if sum(v > 0 for v in stats) < 2 or tops.depth[child] >= rule.max_depth or raw < rule.min_split:
                        tops.ended[child] = True
                    elif raw > rows_a_group(rule.n_features):
                        later.append(child)
        active = later
    return tops


@dataclass
class GrownForest:
    """A forest whose branches are in the table at ``path``. Same use as :class:`~matchspark.models.trees.Forest`."""

    spark: SparkSession
    path: str
    tops: Tops
    limits: list[np.ndarray]
    features: list[str]
    n_rows: int
    n_classes: int
    kind: str = field(default="grown", init=False)

    def votes(self, rows: DataFrame, cuts: Sequence[Cut] = (Cut(),)) -> DataFrame:
        """(_row, tree, shares): class shares under each cut, one after the other. ``rows`` have ``_row`` and ``features``."""
        kind, a_block = vote_kind(cuts), rows_a_block(self.tops.n_trees, cuts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found, of, table = told_votes(batch, kind)
                block, tree = (v[of] for v in _numbers(batch, "block", "tree"))
                shares = table[found["leaf"]].reshape(len(found), -1)
                yield pa.RecordBatch.from_arrays([pa.array(block * a_block + found["row"]), pa.array(tree), pa.array(shares.tolist(), pa.list_(pa.float64()))], ["_row", "tree", "shares"])

        return self._packed_votes(rows, cuts).mapInArrow(run, "_row bigint, tree int, shares array<double>")

    def shares(self, rows: DataFrame, cuts: Sequence[Cut] = (Cut(),), tree_counts: Sequence[int] | None = None) -> DataFrame:
        """(_row, p): mean class shares of the first trees, of each count and cut, one after the other; of all trees by default."""
        kind, counts = vote_kind(cuts), list(tree_counts or [self.tops.n_trees])
        n_trees, a_block = self.tops.n_trees, rows_a_block(self.tops.n_trees, cuts)

        def mean(key: tuple, parts: pa.Table) -> pa.Table:
            # always in the order of the trees, so that reruns agree to the last bit
            parts = parts.sort_by("tree")
            found, of, table = told_votes(parts, kind)
            row, leaf = found["row"].astype(np.int64), found["leaf"]
            ends = np.searchsorted(np.asarray(parts.column("tree"))[of], np.arange(n_trees + 1))
            sums, after = np.zeros((a_block, C * len(cuts))), {}
            for tree in range(n_trees):
                a, b = ends[tree : tree + 2]
                sums[row[a:b]] += table[leaf[a:b]].reshape(b - a, -1)
                if tree + 1 in counts:
                    after[tree + 1] = sums / (tree + 1)
            there = np.flatnonzero(np.bincount(row, minlength=a_block))
            made = np.concatenate([after[n][there] for n in counts], 1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(there) + 1, dtype=np.int32) * made.shape[1]), pa.array(made.ravel()))
            return pa.table([pa.array(key[0].as_py() * a_block + there), lists], ["_row", "p"])

        votes = self._packed_votes(rows, cuts)
        return votes.groupBy("block").applyInArrow(mean, "_row bigint, p array<double>")

    def _packed_votes(self, rows: DataFrame, cuts: Sequence[Cut]) -> DataFrame:
        """(block, tree, votes, shares): votes of a tree on a block of rows, packed (see :func:`vote_kind`)."""
        workers_find_package(self.spark)
        tops, arrays, p, words = self.tops, self.tops.arrays(), len(self.limits), Words.of(self.limits)
        above = self._above(cuts)
        shares_of = {n: np.array(tops.stats[n]) / max(sum(tops.stats[n]), 1e-300) for n in {a for v in above.values() for a in v if a >= 0} | set(np.flatnonzero(arrays.ended))}
        binned_rows = binned(rows, self.limits, ["_row"])
        visit, a_block = np.dtype([("row", "<i8"), ("bins", "<u2", (words.n,))]), rows_a_block(tops.n_trees, cuts)
        # as many parts per branch as there are more rows than it was grown from
        n_rows = rows.count()
        salts, parts = max(1, math.ceil(n_rows / max(self.n_rows, 1))), parts_for(self.spark, n_rows * tops.n_trees)

        def ends(batches: Iterator[pa.RecordBatch], ended: bool):
            """Per tree and larger batch: rows' numbers and words, the tree, and the nodes where they leave its top with their places."""
            for table in larger(batches, p):
                lying = matrix(table.column("bins"), words.n, np.uint16)
                columns, (ids,) = words.columns(lying), _numbers(table, "_row")
                for tree in range(tops.n_trees):
                    found = [(node, r) for node, r in arrays.ends(columns, np.arange(len(ids)), tree) if arrays.ended[node] == ended]
                    if found:
                        yield ids, lying, tree, found

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, lying, _, found in ends(batches, False):
                r, node = np.concatenate([r for _, r in found]), np.repeat([node for node, _ in found], [len(r) for _, r in found])
                made = np.empty(len(r), visit)
                made["row"], made["bins"] = ids[r], lying[r]
                keys, told = packed(node * salts + ids[r] % salts, made)
                yield pa.RecordBatch.from_arrays([pa.array(keys // salts), pa.array(keys % salts), told], ["sub", "salt", "rows"])

        def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, _, tree, found in ends(batches, True):
                r, place = np.concatenate([r for _, r in found]), np.repeat(np.arange(len(found)), [len(r) for _, r in found])
                shares = [np.stack([shares_of[a if a >= 0 else n] for n, _ in found for a in [above.get(n, [n] * len(cuts))[i]]]) for i in range(len(cuts))]
                yield pa.RecordBatch.from_arrays(packed_votes(ids[r], tree, shares, [place] * len(cuts), a_block), VOTES)

        depths, trees = np.array(tops.depth), arrays.tree

        def walk(key: tuple, visits: pa.Table, branches: pa.Table) -> pa.Table:
            sub = key[0].as_py()
            feature, split, left, raw, stats = (np.asarray(branches.column(c)[0].values) for c in ("feature", "bin", "left", "raw", "stats"))
            stats = stats.reshape(-1, C)
            found = unpacked(visits.column("rows"), visit)
            node = leaves_of(words.columns(found["bins"]), steps(feature, split, left))
            share = stats / stats.sum(1, keepdims=True)
            tables, places = [], []
            for cut, a in zip(cuts, above.get(sub, [-1] * len(cuts))):
                if a >= 0:
                    tables.append(shares_of[a][None, :])
                    places.append(np.zeros(len(node), np.int64))
                else:
                    rest = Cut(None if cut.max_depth is None else int(cut.max_depth - depths[sub]), cut.min_split)
                    stands = stands_for(raw, stats.argmax(1), left, np.where(left >= 0, left + 1, -1), rest)
                    tables.append(share)
                    places.append(stands[node])
            return pa.table(packed_votes(found["row"], int(trees[sub]), tables, places, a_block), VOTES)

        visits = binned_rows.mapInArrow(route, "sub bigint, salt bigint, rows binary")
        branches = self.spark.read.schema(BRANCH).parquet(f"{self.path}/branches").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        ddl = "block bigint, tree int, votes binary, shares binary"
        visits, branches = (df.repartition(parts, "sub", "salt") for df in (visits, branches.drop("importance")))
        walked = visits.groupBy("sub", "salt").cogroup(branches.groupBy("sub", "salt")).applyInArrow(_if_visited(walk), ddl)
        every = walked.unionByName(binned_rows.mapInArrow(direct, ddl)) if arrays.ended.any() else walked
        return every.repartition(parts, "block")

    def _above(self, cuts: Sequence[Cut]) -> dict[int, list[int]]:
        """For nodes at the end of the tops: the node above (or itself) that is a leaf under each cut, -1 if there is none."""
        found, t = {}, self.tops
        for n in range(len(t.left)):
            if t.left[n] >= 0:
                continue
            path, at = [], n
            while at >= 0:
                path.append(at)
                at = t.parent[at]
            path = path[::-1]
            ends = [next((a for a in path if t.depth[a] == c.max_depth or (t.raw[a] < c.min_split and t.raw[a] > 0)), -1) for c in cuts]
            if any(a >= 0 and sum(t.stats[a]) > 0 for a in ends):
                found[n] = [a if a >= 0 and sum(t.stats[a]) > 0 else -1 for a in ends]
        return found

    def score(self, df: DataFrame) -> DataFrame:
        """Add p_home, p_draw, p_away and prediction. The rows are written once, numbered."""
        from matchspark.models.trees import assemble

        if self.n_classes != C:
            raise ValueError(f"the model knows {self.n_classes} classes, not {C}")
        had = "features" in df.columns
        rows = cut_lineage(spread(assemble(df, self.features)).withColumn("_row", F.monotonically_increasing_id()))
        voted = self.shares(rows.select("_row", "features")).select("_row", *[F.col("p")[i].alias(name) for i, name in enumerate(PROBABILITIES)])
        joined = (rows if had else rows.drop("features")).join(voted, "_row")
        return joined.select(*[tick(c) for c in df.columns], *PROBABILITIES, top_class(*map(F.col, PROBABILITIES)).alias("prediction"))

    def accuracies(self, df: DataFrame, cuts: Sequence[Cut], tree_counts: Sequence[int]) -> dict[tuple[int, Cut], float]:
        """Accuracy on ``df`` of the forest of each number of trees under each cut; the rows are scored once."""
        rows = cut_lineage(spread(df.select("label", "features")).withColumn("_row", F.monotonically_increasing_id()))
        votes = self.shares(rows.select("_row", "features"), cuts, tree_counts)
        settings = [(count, cut) for count in tree_counts for cut in cuts]
        guesses = [top_class(*[F.col("p")[k * C + c] for c in range(C)]) for k in range(len(settings))]
        right = [F.avg((F.col("label").cast("int") == g).cast("int")).alias(f"a{k}") for k, g in enumerate(guesses)]
        return dict(zip(settings, rows.select("_row", "label").join(votes, "_row").agg(*right).first()))

    def swapped_hits(self, rows: DataFrame, chosen: Sequence[str], following: Sequence[Column]) -> DataFrame:
        """(swap, hits): rows still predicted right when one feature's value comes from another row.

        Swap ``r * len(chosen) + i`` takes feature ``i`` of ``chosen`` from ``following[r]``, an array of all features; the last number is
        for the rows as they are. ``rows`` have ``_row``, ``label`` and the features. A row goes once to each tree with all its swaps; only those that change the
        branch in a tree's top go by themselves, and only changed votes are passed on.
        """
        workers_find_package(self.spark)
        tops, arrays, p, repeats = self.tops, self.tops.arrays(), len(self.limits), len(following)
        places, words, wide_words = [self.features.index(c) for c in chosen], Words.of(self.limits), Words.of(self.limits * (repeats + 1))
        n_swaps = repeats * len(places)
        swap_repeat, swap_feature = np.repeat(np.arange(repeats), len(places)), np.tile(np.array(places, np.int64), repeats)
        share_of = np.array(tops.stats) / np.maximum(np.array(tops.stats).sum(1, keepdims=True), 1e-300)
        top = steps(arrays.feature, arrays.bin, arrays.left)
        n_rows, a_block = rows.count(), max(16, min(SWAPPED_A_BLOCK, VOTES_A_BLOCK // ((n_swaps + 1) * 8 * C)))
        salts, parts = max(1, math.ceil(2 * n_rows / max(self.n_rows, 1))), parts_for(self.spark, n_rows * tops.n_trees * (repeats + 1))
        values = F.concat(F.array(*[tick(c) for c in self.features]), *following)
        wide = binned(rows, self.limits * (repeats + 1), ["_row", "label"], values)
        whole_kind = np.dtype([("row", "<i8"), ("bins", "<u2", (wide_words.n,))])
        alone_kind = np.dtype([("row", "<i8"), ("swap", "<i4"), ("bins", "<u2", (words.n,))])

        def changed(every: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """Swaps x rows: whether the other value takes the row off its path, on which values of each feature lie above ``low`` and up to ``high``."""
            other = every[p:].reshape(repeats, p, -1)[swap_repeat, swap_feature]
            return (other <= low[swap_feature]) | (other > high[swap_feature])

        def walked(batches: Iterator[pa.RecordBatch]):
            """Per batch and tree: rows' numbers, wide bins, the nodes where rows leave the tree's top, and of swaps that change it: swap, row and new node."""
            for table in larger(batches, p * (repeats + 1) * 4):
                every = wide_words.columns(matrix(table.column("bins"), wide_words.n, np.uint16))
                (ids,) = _numbers(table, "_row")
                for tree in range(tops.n_trees):
                    node, low, high = paths_of(every[:p], top, tree)
                    v, i = np.nonzero(changed(every, low, high)) if arrays.left[tree] >= 0 else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    f = swap_feature[v]
                    now = leaves_of(every[:p], top, tree, i, (f, every[(swap_repeat[v] + 1) * p + f, i]))
                    yield table, ids, every, tree, node, v, i, now

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = None
            for table, ids, every, _, node, v, i, now in walked(batches):
                if table is not at:
                    at, lying, plain = table, matrix(table.column("bins"), wide_words.n, np.uint16), words.pack(every[:p], len(ids))
                r = np.flatnonzero(~arrays.ended[node])
                made = np.empty(len(r), whole_kind)
                made["row"], made["bins"] = ids[r], lying[r]
                on = np.flatnonzero(~arrays.ended[now])
                v, i, now = v[on], i[on], now[on]
                other, f = np.empty(len(on), alone_kind), swap_feature[v]
                other["row"], other["swap"] = ids[i], v
                bins, nth, shift = plain[i], np.arange(len(on)), words.shift[f]
                rest = ~(((1 << words.bits[f]) - 1).astype(np.uint16) << shift)
                bins[nth, words.word[f]] = (bins[nth, words.word[f]] & rest) | (every[(swap_repeat[v] + 1) * p + f, i].astype(np.uint16) << shift)
                other["bins"] = bins
                for n, records, column in ((node[r], made, 0), (now, other, 1)):
                    if len(n):
                        keys, told = packed(n * salts + records["row"] % salts, records)
                        none = pa.nulls(len(keys), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(keys // salts), pa.array(keys % salts), *((told, none) if column == 0 else (none, told))], ["sub", "salt", "whole", "alone"])

        def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Votes of nodes that end in the top, and once per batch the labels."""
            at = None
            for table, ids, _, tree, node, v, i, now in walked(batches):
                if table is not at:
                    at, label = table, _numbers(table, "label")[0]
                    yield pa.RecordBatch.from_arrays(packed_changes(ids, np.zeros(len(ids), np.int64), -1, np.eye(C), label, None, a_block), VOTES)
                r, on, off = np.flatnonzero(arrays.ended[node]), np.flatnonzero(arrays.ended[now]), np.flatnonzero(arrays.ended[node[i]])
                for rows, swaps, new, old in ((ids[r], np.full(len(r), n_swaps), node[r], None), (ids[i[on]], v[on], now[on], None), (ids[i[off]], v[off], None, node[i[off]])):
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(packed_changes(rows, swaps, tree, share_of, new, old, a_block), VOTES)

        def walk(key: tuple, visits: pa.Table, branches: pa.Table) -> pa.Table:
            sub = key[0].as_py()
            feature, split, left, stats = (np.asarray(branches.column(c)[0].values) for c in ("feature", "bin", "left", "stats"))
            step, tree, made = steps(feature, split, left), int(arrays.tree[sub]), []
            share = stats.reshape(-1, C)
            share = share / share.sum(1, keepdims=True)
            alone, whole = unpacked(visits.column("alone"), alone_kind), unpacked(visits.column("whole"), whole_kind)
            if len(alone):
                made.append(packed_changes(alone["row"], alone["swap"], tree, share, leaves_of(words.columns(alone["bins"]), step), None, a_block))
            # what leads to this branch in the top
            above_low, above_high = np.full(p, -1, np.int16), np.full(p, 256, np.int16)
            at = sub
            while tops.parent[at] >= 0:
                above = tops.parent[at]
                f = tops.feature[above]
                if at == tops.left[above]:
                    above_high[f] = min(above_high[f], tops.bin[above])
                else:
                    above_low[f] = max(above_low[f], tops.bin[above])
                at = above
            whole = whole[np.argsort(whole["row"], kind="stable")]
            for start in range(0, len(whole), SWAPPED_AT_ONCE):
                ids, every = whole["row"][start : start + SWAPPED_AT_ONCE], wide_words.columns(whole["bins"][start : start + SWAPPED_AT_ONCE])
                node, low, high = paths_of(every[:p], step)
                gone = changed(every, above_low[:, None], above_high[:, None])
                v, i = np.nonzero(changed(every, low, high) & ~gone)
                f = swap_feature[v]
                now = leaves_of(every[:p], step, 0, i, (f, every[(swap_repeat[v] + 1) * p + f, i]))
                other = np.flatnonzero((share[now] != share[node[i]]).any(1))
                v, i, now = v[other], i[other], now[other]
                made.append(packed_changes(ids, np.full(len(ids), n_swaps), tree, share, node, None, a_block))
                made.append(packed_changes(ids[i], v, tree, share, now, node[i], a_block))
                v, i = np.nonzero(gone)
                made.append(packed_changes(ids[i], v, tree, share, None, node[i], a_block))
            return pa.concat_tables([pa.table(m, VOTES) for m in made])

        def count(key: tuple, parts: pa.Table) -> pa.Table:
            kind, size = change_kind(), n_swaps + 1
            sums, label = np.zeros((a_block * size, C)), np.full(a_block, -1)
            # in the order of the trees, labels first
            parts = parts.sort_by("tree")
            for tree, told, extra in zip(parts.column("tree").to_pylist(), parts.column("votes"), parts.column("shares")):
                found = np.frombuffer(told.as_buffer(), kind)
                if tree < 0:
                    label[found["row"]] = found["change"] // (C + 1) - 1
                else:
                    table = np.concatenate([CHANGES, np.frombuffer(extra.as_buffer(), np.float64).reshape(-1, C)])
                    # a swap changes a row once in a branch
                    sums[found["row"].astype(np.int64) * size + found["swap"]] += table[found["change"]]
            there = label >= 0
            sums = sums.reshape(a_block, size, C)[there]
            sums[:, :n_swaps] += sums[:, n_swaps:]
            # sums of the same votes may differ in their last bits
            hits = (np.round(sums, 9).argmax(2) == label[there][:, None]).sum(0)
            return pa.table([pa.array(np.arange(size, dtype=np.int32)), pa.array(hits.astype(np.int64))], ["swap", "hits"])

        ddl = "block bigint, tree int, votes binary, shares binary"
        visits = wide.mapInArrow(route, "sub bigint, salt bigint, whole binary, alone binary")
        branches = self.spark.read.schema(BRANCH).parquet(f"{self.path}/branches").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        visits, branches = (df.repartition(parts, "sub", "salt") for df in (visits, branches.drop("importance")))
        votes = visits.groupBy("sub", "salt").cogroup(branches.groupBy("sub", "salt")).applyInArrow(_if_visited(walk), ddl)
        votes = votes.unionByName(wide.mapInArrow(direct, ddl)).repartition(parts, "block")
        return votes.groupBy("block").applyInArrow(count, "swap int, hits bigint").groupBy("swap").agg(F.sum("hits").alias("hits"))

    def importances(self) -> list[tuple[str, float]]:
        """Gain times weight of a feature's splits, as shares of a tree, averaged over the trees."""
        p, t = len(self.limits), self.tops
        trees = np.zeros((t.n_trees, p))
        for n in range(len(t.left)):
            if t.left[n] >= 0:
                trees[t.tree[n], t.feature[n]] += t.gain[n] * sum(t.stats[n])
        tree_of = self.spark.createDataFrame([(n, t.tree[n]) for n in range(len(t.left)) if t.left[n] < 0 and not t.ended[n]], "sub bigint, tree int")
        branches = self.spark.read.schema(BRANCH).parquet(f"{self.path}/branches").select("sub", F.posexplode("importance").alias("place", "value"))
        # summed by branch, so that the order of the sum doesn't hang on the tasks
        for r in branches.where("value > 0").join(tree_of, "sub").groupBy("tree", "place").agg(F.array_sort(F.collect_list("value")).alias("values")).collect():
            trees[r["tree"], r["place"]] += sum(r["values"])
        whole = trees.sum(1, keepdims=True)
        shares = np.divide(trees, whole, out=np.zeros_like(trees), where=whole > 0).sum(0)
        return [(name, float(v)) for name, v in zip(self.features, shares / (shares.sum() or 1.0))]

    def save(self, path: str) -> None:
        self.spark.read.schema(BRANCH).parquet(f"{self.path}/branches").write.mode("overwrite").parquet(f"{path}/branches")
        told = {"tops": vars(self.tops), "limits": [v.tolist() for v in self.limits], "n_rows": self.n_rows, "n_classes": self.n_classes}
        self.spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/tops")

    @staticmethod
    def load(spark: SparkSession, path: str, features: list[str]) -> "GrownForest":
        told = json.loads(spark.read.text(f"{path}/tops").first()["value"])
        return GrownForest(spark, path, Tops(**told["tops"]), [np.array(v, float) for v in told["limits"]], features, told["n_rows"], told["n_classes"])


VOTES = ["block", "tree", "votes", "shares"]


def vote_kind(cuts: Sequence[Cut]) -> np.dtype:
    """A vote: the row's place in its block, and under each cut the class that has the whole leaf, or the place of its shares among those beside the votes."""
    return np.dtype([("row", "<u2"), ("leaf", "<u2", (len(cuts),))])


def rows_a_block(n_trees: int, cuts: Sequence[Cut]) -> int:
    """So many that their votes and shares stay below ``VOTES_A_BLOCK`` bytes, and places are told in 16 bits."""
    size = vote_kind(cuts).itemsize + 8 * C * len(cuts)
    return min(MOST_A_BLOCK, max(ROWS_A_BLOCK, VOTES_A_BLOCK // (n_trees * size)), (2**16 - C) // len(cuts))


def packed_votes(ids: np.ndarray, tree: int, tables: Sequence[np.ndarray], places: Sequence[np.ndarray], a_block: int) -> list[pa.Array]:
    """Votes of one tree on some rows as columns ``VOTES``: under each cut the shares at the row's place in the table."""
    order = np.argsort(ids, kind="stable")
    ids, cuts = ids[order], len(tables)
    block, first, size = np.unique(ids // a_block, return_index=True, return_counts=True)
    made, mixed_shares = np.empty(len(ids), vote_kind([Cut()] * cuts)), np.zeros((len(ids), cuts), bool)
    made["row"] = ids % a_block
    for i, (table, place) in enumerate(zip(tables, places)):
        whole = (table == 1.0) & ((table != 0).sum(1) == 1)[:, None]
        at = place[order]
        made["leaf"][:, i], mixed_shares[:, i] = whole.argmax(1)[at], ~whole.any(1)[at]
    row, cut = np.nonzero(mixed_shares)
    extra = np.empty((len(row), C))
    for i, (table, place) in enumerate(zip(tables, places)):
        extra[cut == i] = table[place[order[row[cut == i]]]]
    before = np.searchsorted(row, np.append(first, len(ids)))
    of = np.repeat(np.arange(len(block)), np.diff(before))
    made["leaf"][row, cut] = C + np.arange(len(row)) - before[of]
    return [pa.array(block), pa.array(np.full(len(block), tree, np.int32)), blobs(made, size), blobs(extra.view(f"V{8 * C}").ravel(), np.diff(before))]


def told_votes(parts: pa.RecordBatch | pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes of all ``parts`` in their order, the part that each is from, and the shares that their leaves are places in."""
    votes, shares = parts.column("votes"), parts.column("shares")
    sizes, extra = (np.asarray(pc.binary_length(c)) // n for c, n in ((votes, kind.itemsize), (shares, 8 * C)))
    found, of = unpacked(votes, kind), np.repeat(np.arange(len(sizes)), sizes)
    wide = np.dtype([("row", kind["row"]), ("leaf", "<i8", kind["leaf"].shape)])
    out = np.empty(len(found), wide)
    out["row"] = found["row"]
    leaf = found["leaf"].astype(np.int64)
    leaf += np.where(leaf >= C, (np.cumsum(extra) - extra)[of][:, None], 0)
    out["leaf"] = leaf
    return out, of, np.concatenate([np.eye(C), matrix(shares, C, np.float64)])


# a vote taken from no class or a whole one and given to none or a whole one: (given + 1) * (C + 1) + taken + 1
CHANGES = (np.eye(C + 1, C, -1)[:, None] - np.eye(C + 1, C, -1)[None, :]).reshape(-1, C)


def change_kind() -> np.dtype:
    """What a swap changes in a row's vote: the row's place in its block, the swap, and a place in ``CHANGES`` or behind it among the sums beside."""
    return np.dtype([("row", "<u2"), ("swap", "<u4"), ("change", "<u4")])


def packed_changes(ids: np.ndarray, swaps: np.ndarray, tree: int, table: np.ndarray, new: np.ndarray | None, old: np.ndarray | None, a_block: int) -> list[pa.Array]:
    """Columns ``VOTES`` of votes given to the shares at ``new`` of the table and taken from those at ``old``, where these are there."""
    order = np.argsort(ids // a_block, kind="stable")
    ids, swaps = ids[order], swaps[order]
    new, old = (None if at is None else at[order] for at in (new, old))
    block, first, size = np.unique(ids // a_block, return_index=True, return_counts=True)
    whole = (table == 1.0) & ((table != 0).sum(1) == 1)[:, None]
    code = np.where(whole.any(1), whole.argmax(1) + 1, -1)
    given, taken = (np.zeros(len(ids), np.int64) if at is None else code[at] for at in (new, old))
    made = np.empty(len(ids), change_kind())
    made["row"], made["swap"] = ids % a_block, swaps
    row = np.flatnonzero((given < 0) | (taken < 0))
    made["change"] = np.where((given < 0) | (taken < 0), 0, given * (C + 1) + taken)
    extra = (0.0 if new is None else table[new[row]]) - (0.0 if old is None else table[old[row]])
    extra = np.ascontiguousarray(np.broadcast_to(extra, (len(row), C)))
    before = np.searchsorted(row, np.append(first, len(ids)))
    made["change"][row] = len(CHANGES) + np.arange(len(row)) - np.repeat(before[:-1], np.diff(before))
    return [pa.array(block), pa.array(np.full(len(block), tree, np.int32)), blobs(made, size), blobs(extra.view(f"V{8 * C}").ravel(), np.diff(before))]


def steps(feature: np.ndarray, split: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Nodes as one number each, of left child, feature and last bin of the left side. A leaf leads to itself."""
    inner = (left.astype(np.int64) << 32) | (feature.astype(np.int64) << 8) | split
    return np.where(left >= 0, inner, (np.arange(len(left)) << 32) | 255)


def leaves_of(columns: np.ndarray, step: np.ndarray, root: int = 0, rows: np.ndarray | None = None, swap: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The leaf of each row, or each of ``rows``, whose bins are ``columns``, a line per feature. ``swap`` has a feature and its bin instead for each."""
    n = columns.shape[1]
    flat, rows = columns.ravel(), np.arange(n) if rows is None else rows
    node, going, at, levels = np.full(len(rows), root), np.arange(len(rows)), np.full(len(rows), root), 0
    feature, value = swap or (None, None)
    while len(going):
        told = step.take(at)
        tested = (told >> 8) & 0xFFFFFF
        bins = flat.take(tested * n + rows)
        if swap:
            bins = np.where(tested == feature, value, bins)
        at = (told >> 32) + (bins > (told & 0xFF))
        levels += 1
        if levels % 3 == 0 or len(step) < 8:
            stay = step.take(at) >> 32 != at
            node[going[~stay]] = at[~stay]
            going, at, rows = going[stay], at[stay], rows[stay]
            if swap:
                feature, value = feature[stay], value[stay]
    return node


def paths_of(columns: np.ndarray, step: np.ndarray, root: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The leaf of each row, and per feature and row the bins between which the row would go the same way: above the first, up to the second."""
    p, n = columns.shape
    flat, low, high = columns.ravel(), np.full((p, n), -1, np.int16), np.full((p, n), 256, np.int16)
    node, going = np.full(n, root), np.arange(n)
    lows, highs = low.ravel(), high.ravel()
    while True:
        told = step.take(node[going])
        stay = told >> 32 != node[going]
        going, told = going[stay], told[stay]
        if not len(going):
            return node, low, high
        cell, limit = ((told >> 8) & 0xFFFFFF) * n + going, told & 0xFF
        right = flat.take(cell) > limit
        node[going] = (told >> 32) + right
        lows[cell[right]] = np.maximum(lows[cell[right]], limit[right])
        highs[cell[~right]] = np.minimum(highs[cell[~right]], limit[~right])


def _if_visited(walk):
    """A branch that no row reaches gives nothing."""
    empty = pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary())], VOTES)
    return lambda key, visits, branches: walk(key, visits, branches) if visits.num_rows and branches.num_rows else empty


def parts_for(spark: SparkSession, visits: int) -> int:
    """Tasks for so many visits of rows to trees. Little data takes long to work on, so tasks aren't left to its size."""
    return max(math.ceil(visits / VISITS_A_TASK), 4 * spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """Over all cores, and in files of at most ``ROWS_A_FILE`` rows."""
    return df.repartition(max(math.ceil(df.count() / ROWS_A_FILE), df.sparkSession.sparkContext.defaultParallelism))


@dataclass
class BinnedRows:
    """Rows as forests are grown from them, written once for any number of forests: ``_row``, ``label``, weights and ``bins``."""

    rows: DataFrame
    limits: list[np.ndarray]
    max_bins: int
    n_rows: int
    n_classes: int


def bin_rows(rows: DataFrame, n_features: int, max_bins: int, weights: Sequence[str] = ("weight",)) -> BinnedRows:
    """Bins depend on the features alone, so forests under several weights share them. ``rows`` have ``label`` and the feature vector."""
    workers_find_package(rows.sparkSession)
    doubles = [F.col(tick(w)).cast("double").alias(w) for w in weights]
    numbered = rows.select(F.monotonically_increasing_id().alias("_row"), F.col("label").cast("int").alias("label"), *doubles, "features")
    # before the passes over all values, since a table of few files would leave cores idle
    numbered = cut_lineage(spread(numbered))
    limits = thresholds(numbered, n_features, max_bins)
    ready = cut_lineage(binned(numbered, limits, ["_row", "label", *weights]))
    n_rows, top_label = ready.agg(F.count(F.lit(1)), F.max("label")).first()
    return BinnedRows(ready, limits, max_bins, n_rows, (-1 if top_label is None else top_label) + 1)


def grow_forest(rows: DataFrame, features: Sequence[str], settings, max_depth: int) -> GrownForest:
    """Grow on ``label``, ``weight`` and the feature vector."""
    return grow_binned(bin_rows(rows, len(features), settings.max_bins), features, settings, max_depth)


def grow_binned(table: BinnedRows, features: Sequence[str], settings, max_depth: int, weight: str | None = "weight") -> GrownForest:
    """Grow on rows that are binned already; ``weight`` names one of their weights, None: all rows weigh 1."""
    spark, p, seed = table.rows.sparkSession, len(features), settings.seed
    if settings.max_bins != table.max_bins:
        raise ValueError(f"rows are in {table.max_bins} bins, not {settings.max_bins}")
    rule = Rule(p, subset_size(settings.feature_subset, p), settings.max_bins, settings.min_leaf, settings.min_split, max_depth)
    ready = table.rows.select("_row", "label", (F.col(tick(weight)) if weight else F.lit(1.0)).alias("weight"), "bins")
    limits, n_rows, n_classes = table.limits, table.n_rows, table.n_classes
    words = Words.of(limits)
    tops = _grow_tops(ready, n_rows, settings.n_trees, rule, seed, settings.max_memory_mb, words)
    arrays, hashes, depths = tops.arrays(), tops.hashes, tops.depth
    starts = tree_hashes(np.arange(settings.n_trees), seed)
    # rows that all weigh 1 don't carry it
    least, most = ready.agg(F.min("weight"), F.max("weight")).first()
    carried = [] if least == most == 1.0 else [("weight", "<f8")]
    kind = np.dtype([("row", "<i8"), *carried, ("times", "u1"), ("bins", "<u2", (words.n,))])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in larger(batches, p):
            lying = matrix(table.column("bins"), words.n, np.uint16)
            columns = words.columns(lying)
            ids, label, weight = _numbers(table, "_row", "label", "weight")
            hashed = mixed(ids.astype(np.uint64))
            for tree, start in enumerate(starts):
                times = times_of(mixed(hashed ^ start))
                found = [(node, r) for node, r in arrays.ends(columns, np.flatnonzero(times), tree) if not arrays.ended[node]]
                if found:
                    r = np.concatenate([r for _, r in found])
                    made = np.empty(len(r), kind)
                    made["row"], made["times"], made["bins"] = ids[r], times[r] * C + label[r], lying[r]
                    if carried:
                        made["weight"] = weight[r]
                    yield pa.RecordBatch.from_arrays([pa.array([node for node, _ in found]), blobs(made, [len(r) for _, r in found])], ["sub", "rows"])

    def grow(key: tuple, group: pa.Table) -> pa.Table:
        sub, rows = key[0].as_py(), unpacked(group.column("rows"), kind)
        rows = rows[np.argsort(rows["row"])]
        times, label = np.divmod(rows["times"].astype(np.int64), C)
        weight = rows["weight"] * times if carried else times.astype(float)
        b = grow_branch(words.columns(rows["bins"]), label, weight, times, hashes[sub], depths[sub], rule)
        used = b["feature"] >= 0
        told = np.bincount(b["feature"][used], (b["gain"] * b["stats"].sum(1))[used], p).astype(float, copy=False)
        made = [[sub], *[[b[c].astype(np.int32)] for c in ("feature", "bin", "left")], [b["raw"].astype(np.int64)], [b["stats"].ravel()], [told]]
        return pa.table([pa.array(v) for v in made], ["sub", "feature", "bin", "left", "raw", "stats", "importance"])

    path = scratch_path(spark, "grown")
    visits = ready.mapInArrow(route, "sub bigint, rows binary")
    visits = visits.repartition(parts_for(spark, n_rows * settings.n_trees), "sub")
    visits.groupBy("sub").applyInArrow(grow, BRANCH).write.parquet(f"{path}/branches")
    return GrownForest(spark, path, tops, limits, list(features), n_rows, n_classes)
