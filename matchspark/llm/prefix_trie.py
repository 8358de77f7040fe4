"""The trie of conversation prefixes, summed bottom-up by time-forward processing.

1. Turns are reduced to a digest and a text length, dealt by group of five conversations and sorted. One pass over the
   sorted rows rebuilds every conversation, names each of its prefixes by a chain of 128-bit hashes and keeps nothing but the
   current chain and the first eight turns of the group's first conversation.
2. Prefixes with more than a limit of members are heavy. The limit grows with the table, so that there are at most
   ``most_heavy`` of them; they form the top of the trie. Below it, every light node with a heavy parent (or the
   root) is the root of a subtree with a bounded number of conversations. Subtrees are dealt into shards.
3. A shard's nodes are sorted externally in reverse level order: deepest first. A node takes the messages its children left for
   it in a priority queue, adds its own part and leaves a message for its parent, which comes later in the same order. A
   queue of more than a limit of messages spills sorted runs to the task's spill folder.
4. Messages of shard roots are summed by parent before they move. The same pass over the top of the trie ends them.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import struct
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import workers_find_package
from matchspark.session import cut_lineage

#: Conversations ``GROUP * k`` to ``GROUP * k + GROUP - 1`` share a beginning; at most ``MOST_SHARED - 1`` turns of it.
GROUP, MOST_SHARED = 5, 9
ROOT = bytes(16)
ROWS = 8192
EMPTY_SHA = hashlib.sha256().hexdigest()


@dataclass(frozen=True)
class TrieSettings:
    """Members from which on a node may be heavy; heavy nodes at most; messages a queue holds in memory."""

    light_members: int = 1000
    most_heavy: int = 200_000
    queue: int = 100_000


# -- rebuilt conversations and their prefixes -----------------------------------------------------


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the first one of its group."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


ENTRY = "hi long, lo long, depth long, up_hi long, up_lo long, bytes long, conv_id long, top_hi long, top_lo long, ends boolean"


def prefix_entries(rows: Iterator[tuple[int, int, bytes, int]], heavy: frozenset[bytes]) -> Iterator[tuple]:
    """One tuple (``ENTRY``) per conversation and prefix from sorted (group, conv_id, digest, bytes) rows.

    ``top`` names the light node nearest to the root on the prefix's path, null for heavy prefixes.
    """
    first: list[tuple[bytes, int]] = []
    group = conv = None
    key, depth, top, entry, own, share = ROOT, 0, None, None, 0, 0
    names = struct.Struct("<qq").unpack

    def step(digest: bytes, size: int) -> tuple:
        nonlocal key, depth, top
        up, key = key, hashlib.blake2b(key + digest, digest_size=16).digest()
        depth += 1
        if top is None and key not in heavy:
            top = key
        return (*names(key), depth, *names(up), size, conv, *(names(top) if top else (None, None)))

    for at, c, digest, size in rows:
        if c != conv or at != group:
            if entry:
                yield (*entry, True)
            if at != group:
                group, first = at, []
            conv, own, share = c, 0, shared_turns(c)
            key, depth, top = ROOT, 0, None if ROOT in heavy else ROOT
            entry = (0, 0, 0, None, None, 0, c, *((None, None) if top is None else (0, 0)))
            for turn in first[:share] if c != at else []:
                yield (*entry, False)
                entry = step(*turn)
        own += 1
        if c == at and own < MOST_SHARED:
            first.append((digest, size))
        if own > share or c == at:
            yield (*entry, False)
            entry = step(digest, size)
    if entry:
        yield (*entry, True)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, ROWS).columns))


def _arrow(ddl: str) -> pa.Schema:
    types = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(name, types[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def digested(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(group, conv_id, turn, digest, bytes) of every turn that belongs to a conversation."""
    of, said, words = F.col(f"`{conv_id}`").cast("long"), F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    whole = F.concat(F.length(said).cast("string"), F.lit(":"), said, words)
    return turns.select(
        (of - of % GROUP).alias("group"), of.alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"), F.octet_length(words).cast("long").alias("bytes"),
    ).where("conv_id IS NOT NULL")


def _entries(slim: DataFrame, heavy: frozenset[bytes], only_keys: bool) -> DataFrame:
    ordered = slim.repartition("group").sortWithinPartitions(
        "group", F.col("conv_id") != F.col("group"), "conv_id", F.asc_nulls_first("turn"), "digest", "bytes"
    )
    ddl = "hi long, lo long" if only_keys else ENTRY
    schema, sent = _arrow(ddl), slim.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = prefix_entries(_tuples(batches), sent.value)
        yield from _batched((e[:2] for e in made) if only_keys else made, schema)

    return ordered.select("group", "conv_id", "digest", "bytes").mapInArrow(run, ddl)


# -- time-forward processing ----------------------------------------------------------------------


class SpillingQueue:
    """A priority queue of tuples of whole numbers; all but ``limit`` of them lie in sorted runs on disk.

    Runs are unnamed files in Spark's own spill folder and go with the task. More than ``MOST_RUNS`` are merged into one.
    """

    MOST_RUNS = 32

    def __init__(self, fields: int, limit: int):
        self.packer, self.limit = struct.Struct(f"<{fields}q"), limit
        self.heap: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []
        self.heads: list[tuple[tuple, int]] = []
        self.spills = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill(iter(sorted(self.heap)))
            self.heap = []

    def first(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, run = self.heads[0]
            following = next(self.runs[run], None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, run))
            return item
        return heapq.heappop(self.heap)

    def _spill(self, items: Iterator[tuple]) -> None:
        if len(self.heads) >= self.MOST_RUNS:
            rest = [self._from(head, self.runs[run]) for head, run in self.heads]
            items, self.heads, self.runs = heapq.merge(items, *rest), [], []
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        for item in items:
            file.write(self.packer.pack(*item))
        file.seek(0)
        self.spills += 1
        run = self._read(file)
        head = next(run, None)
        if head is not None:
            self.runs.append(run)
            heapq.heappush(self.heads, (head, len(self.runs) - 1))

    @staticmethod
    def _from(head: tuple, run: Iterator[tuple]) -> Iterator[tuple]:
        yield head
        yield from run

    def _read(self, file: IO[bytes]) -> Iterator[tuple]:
        with file:
            while block := file.read(self.packer.size * 1024):
                yield from self.packer.iter_unpack(block)


NODE = ("hi", "lo", "depth", "conv_id", "up_hi", "up_lo", "n_convs", "bytes", "is_top", "children", "leaves", "saved")
TOTAL = (
    "hi long, lo long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "up_hi long, up_lo long"
)


def subtree_totals(nodes: Iterator[tuple], limit: int) -> Iterator[tuple]:
    """``TOTAL`` of every node from ``NODE`` tuples, deepest first and by name within a depth.

    A node's row is made when its parent, which knows the smallest member, is reached. Rows of tops have no
    ``parent_conv_id`` but the name of their parent, if they have one. ``children``, ``leaves`` and ``saved`` are what came from
    elsewhere.
    """
    queue = SpillingQueue(11, limit)
    for hi, lo, depth, conv, up_hi, up_lo, members, size, is_top, children, leaves, saved in nodes:
        saved += (members - 1) * size
        while (message := queue.first()) and message[:3] == (-depth, hi, lo):
            _, _, _, c_hi, c_lo, c_conv, c_members, c_children, c_leaves, c_saved, _ = queue.pop()
            children += 1
            leaves += c_leaves
            saved += c_saved
            yield c_hi, c_lo, depth + 1, c_conv, conv, c_members, c_children, c_leaves, c_saved, None, None
        leaves = leaves if children else 1
        if is_top:
            yield hi, lo, depth, conv, None, members, children, leaves, saved, up_hi, up_lo
        else:
            queue.push((1 - depth, up_hi, up_lo, hi, lo, conv, members, children, leaves, saved, depth))
    if queue.first():
        raise ValueError("a node's parent is missing, or nodes are not in reverse level order")


def _totals(nodes: DataFrame, limit: int) -> DataFrame:
    schema = _arrow(TOTAL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(subtree_totals(_tuples(batches), limit), schema)

    return nodes.sortWithinPartitions(F.desc("depth"), "hi", "lo").select(*NODE).mapInArrow(run, TOTAL)


def _end_hashes(entries: DataFrame) -> DataFrame:
    """(e_hi, e_lo, ends_sha256) of every node at which a conversation ends; ids are hashed as they come out of the sort."""
    ordered = entries.where("ends").select("hi", "lo", "conv_id").repartition("hi", "lo").sortWithinPartitions("hi", "lo", "conv_id")
    ddl = "e_hi long, e_lo long, ends_sha256 string"
    schema = _arrow(ddl)

    def hashes(rows: Iterator[tuple]) -> Iterator[tuple]:
        at, digest = None, None
        for hi, lo, conv in rows:
            if at != (hi, lo):
                if at:
                    yield (*at, digest.hexdigest())
                at, digest = (hi, lo), hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
        if at:
            yield (*at, digest.hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(hashes(_tuples(batches)), schema)

    return ordered.mapInArrow(run, ddl)


def _same(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return (F.col(a[0]) == F.col(b[0])) & (F.col(a[1]) == F.col(b[1]))


def prefix_trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", settings: TrieSettings = TrieSettings()
) -> DataFrame:
    """One row per distinct beginning (role, text of the first ``depth`` turns) of the rebuilt conversations.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Turns are ordered by ``turn``, null first, then by a digest of role and text;
    null role and text are empty. Repeated rows are turns of their own. Rows without ``conv_id`` belong to no conversation
    and are left out. Texts are told apart by 128 bits of SHA-256. Extra columns are ignored, whatever their names.
    An empty table gives no node, not even a root.
    """
    workers_find_package(turns.sparkSession)
    slim = cut_lineage(digested(turns, conv_id, turn, role, text))
    # A conversation gets at most eight turns from elsewhere, so there are fewer than ten entries per turn.
    limit = max(settings.light_members, slim.count() * (MOST_SHARED + 1) // settings.most_heavy)
    sizes = _entries(slim, frozenset(), only_keys=True).groupBy("hi", "lo").agg(F.count("*").alias("n"))
    heavy = frozenset(struct.pack("<qq", r.hi, r.lo) for r in sizes.where(F.col("n") > limit).select("hi", "lo").collect())
    entries = cut_lineage(_entries(slim, heavy, only_keys=False))
    alike = {c: F.min(c).alias(c) for c in ("depth", "up_hi", "up_lo", "bytes", "top_hi", "top_lo", "conv_id")}
    nodes = cut_lineage(entries.groupBy("hi", "lo").agg(F.count("*").alias("n_convs"), *alike.values()))
    none = F.lit(0).cast("long")
    is_top = _same(("hi", "lo"), ("top_hi", "top_lo"))
    light = nodes.where("top_hi IS NOT NULL").withColumns({"is_top": is_top, "children": none, "leaves": none, "saved": none})
    below = _totals(light.repartition("top_hi", "top_lo"), settings.queue)
    if heavy:
        below = cut_lineage(below)
        arrived = below.where("up_hi IS NOT NULL").groupBy("up_hi", "up_lo").agg(
            F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        inbox = arrived.select(F.col("up_hi").alias("to_hi"), F.col("up_lo").alias("to_lo"), "children", "leaves", "saved")
        top = nodes.where("top_hi IS NULL").join(inbox, _same(("hi", "lo"), ("to_hi", "to_lo")), "left")
        top = top.na.fill(0, ["children", "leaves", "saved"]).withColumn("is_top", F.col("depth") == 0)
        # At most ``most_heavy`` rows, whatever the table's size.
        above = cut_lineage(_totals(top.coalesce(1), settings.queue))
        parents = above.select(F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), F.col("conv_id").alias("p_conv"))
        roots = below.where("up_hi IS NOT NULL").join(parents, _same(("up_hi", "up_lo"), ("p_hi", "p_lo")))
        roots = roots.withColumn("parent_conv_id", F.col("p_conv")).select(*below.columns)
        below = below.where("up_hi IS NULL").union(roots).union(above)
    out = below.join(_end_hashes(entries), _same(("hi", "lo"), ("e_hi", "e_lo")), "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )
