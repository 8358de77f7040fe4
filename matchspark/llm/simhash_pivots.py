"""SimHash near-duplicates with pivot distance tables.

Every distinct fingerprint gets a row of Hamming distances to many reference fingerprints (pivots). By the
triangle inequality two fingerprints that differ in at most ``reach`` bits have distances that differ by at
most ``reach`` for every pivot; a pair with a larger coordinate difference is discarded unseen, and the
rest is verified on the fingerprints themselves.

Pivots are the empty fingerprint, one for every block of two bits (all other bits 0), and some spread ones.
For block ``b``, ``(d(0) + 2 - d(b)) / 2`` is a coordinate from 0 to 2 which only bits of that block can change, so
``reach`` differing bits change at most ``reach`` coordinates. The coordinates are dealt into groups: two near
fingerprints agree in all groups but ``reach``, and meet in a table keyed by some choice of that many
groups. No pair is lost, and none is looked for outside these tables.

Fingerprints that crowd one key (copies edited in a word or two) are linked without forming pairs: two
fingerprints within 2 bits share a fingerprint at most 1 bit away from both, so each is listed under itself and
its 64 neighbours and linked to the smallest one listed there.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import Numbered, largest_row, map_texts
from matchspark.llm.components import components
from matchspark.session import cut_lineage

REACH = 2
SHINGLE = 3
SEED = 42
BLOCK = 2
#: Spread pivots: multiples of an odd constant, one bit pattern each.
SPREAD = [(k * 0x9E3779B97F4A7C15) % (1 << 64) for k in range(1, 17)]
#: Fingerprints under one key from which on they are linked through shared neighbours.
CROWD = 64

_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.float64)


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(texts: list[str | None], size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """SimHash of whole texts as unsigned 64-bit numbers.

    A-Z is lowered, words are cut at the six white space characters, shingles of ``size`` words count as often
    as they occur. A bit is set if it is set in over half of the XXH64 values. Fewer words than that are
    one shingle; no word gives zero.
    """
    from xxhash import xxh64_digest

    digests: list[bytes] = []
    lengths = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.encode().lower().split() if text else []
        if not words:
            continue
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size)))) if len(words) >= size else [b" ".join(words)]
        made = [xxh64_digest(s, seed) for s in shingles]
        digests += made
        lengths[i] = len(made)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    # Digests are big-endian. Count the values of each of the 8 bytes per text, then weigh them by their bits.
    values = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
    ends = np.cumsum(lengths[full])
    places = np.arange(8, dtype=np.int64) * 256
    for a in range(0, len(full), 512):
        b = min(a + 512, len(full))
        start = ends[a - 1] if a else 0
        of_text = np.repeat(np.arange(b - a, dtype=np.int64) * 2048, lengths[full[a:b]])
        keys = of_text[:, None] + places + values[start : ends[b - 1]]
        counted = np.bincount(keys.ravel(), minlength=(b - a) * 2048).reshape(b - a, 8, 256)
        ones = np.rint(counted @ _BITS).astype(np.int64).reshape(b - a, 64)
        bits = (2 * ones > lengths[full[a:b]][:, None]).astype(np.uint8)
        out[full[a:b]] = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def fingerprinted(docs: DataFrame, text: str = "text", name: str = "fp", keep_text: bool = False) -> DataFrame:
    """``docs`` with the fingerprint as a signed long column ``name``."""

    def make():
        return lambda texts: [fingerprints(texts).view(np.int64)]

    return map_texts(docs, text, [(name, "long")], make, keep_text=keep_text, chars_per_slice=4_000_000)


def distance(a: Column, b: Column | int) -> Column:
    return F.bit_count(a.bitwiseXOR(F.lit(signed(b)).cast("long") if isinstance(b, int) else b)).cast("int")


def pivot_table(points: DataFrame) -> DataFrame:
    """(fp, table, coords): distances to all pivots, and the block coordinates worked out from them."""
    blocks = [((1 << BLOCK) - 1) << (BLOCK * b) for b in range(64 // BLOCK)]
    pivots = [0, *blocks, *SPREAD]
    table = F.array(*[distance(F.col("fp"), p).cast("tinyint") for p in pivots])
    coords = F.transform(F.slice("table", 2, len(blocks)), lambda d: ((F.element_at("table", 1) + BLOCK - d) / 2).cast("tinyint"))
    return points.select("fp", table.alias("table")).withColumn("coords", coords)


def _keys(groups: int, reach: int) -> tuple[dict[int, Column], Column]:
    """The coordinates of each group as one number, and an array of keys: one for every choice of the groups that
    near fingerprints agree in, made of the choice's place and the numbers (columns g0, g1, ...) of its groups."""
    n = 64 // BLOCK
    parts = [list(range(g, n, groups)) for g in range(groups)]
    one = {g: F.aggregate(F.array(*[F.element_at("coords", i + 1) for i in parts[g]]), F.lit(0).cast("long"), lambda acc, c: acc * 3 + c) for g in range(groups)}
    radix = 3 ** max(map(len, parts))
    made = []
    for k, chosen in enumerate(combinations(range(groups), groups - reach)):
        key = F.lit(k).cast("long")
        for g in chosen:
            key = key * F.lit(radix) + F.col(f"g{g}")
        made.append(key)
    return one, F.array(*made)


def pivot_links(points: DataFrame, groups: int = 4, reach: int = REACH, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) that connect exactly the distinct fingerprints ``points`` (fp) within ``reach`` bits of each other.

    Linked pairs are within ``reach`` bits, or both are within 1 bit of one fingerprint. More ``groups`` make longer
    keys for more fingerprints; the links are the same.
    """
    if reach != 2 or not reach < groups <= 6:
        raise ValueError("links are made for 2 differing bits and 3 to 6 groups")
    one, keys = _keys(groups, reach)
    table = pivot_table(points).withColumns({f"g{g}": e for g, e in one.items()})
    keyed = cut_lineage(table.select("fp", "table", F.explode(keys).alias("key")))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    busy = cut_lineage(sizes)
    few = busy.where(F.col("n") <= crowd).select("key")
    a = keyed.join(few, "key", "left_semi")
    b = a.select(F.col("key").alias("key_b"), F.col("fp").alias("fp_b"), F.col("table").alias("table_b"))
    near = F.forall(F.zip_with("table", "table_b", lambda x, y: F.abs(x - y) <= reach), lambda ok: ok)
    pairs = (
        a.join(b, (F.col("key") == F.col("key_b")) & (F.col("fp") < F.col("fp_b")) & near)
        .where(distance(F.col("fp"), F.col("fp_b")) <= reach)
        .select(F.col("fp").alias("u"), F.col("fp_b").alias("v"))
    )
    crowded = busy.where(F.col("n") > crowd).select("key")
    members = keyed.join(crowded, "key", "left_semi").select("fp").distinct()
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i)).cast("long")) for i in range(64)])
    listed = members.select("fp", F.explode(around).alias("at"))
    # At most 65 fingerprints are listed under one.
    heads = listed.groupBy("at").agg(F.min("fp").alias("head"), F.count("*").alias("n")).where("n > 1").select(F.col("at").alias("h_at"), "head")
    shared = listed.join(heads, F.col("at") == F.col("h_at")).where("fp <> head").select(F.col("fp").alias("u"), F.col("head").alias("v"))
    return pairs.union(shared)


def _groups_for(distinct: int) -> int:
    """Longer keys for more fingerprints, so that a key meets a bounded number of strangers; links don't change."""
    return 4 if distinct < 1 << 25 else 5 if distinct < 1 << 30 else 6


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD, check: bool = False) -> DataFrame:
    """(doc_id, check, fp, root, component_id) of every row; ``root`` is the smallest fingerprint of the group.

    ``component_id`` is the smallest id reachable over links of at most 2 differing bits, the row's own
    included; null only if all ids reachable are null. Equal fingerprints, also those of texts without
    words (zero), are one point, so copies form no pairs. ``check`` adds a hash of the text.
    """
    hashed = F.xxhash64(F.col(f"`{text}`")) if check else F.lit(None).cast("long")
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), hashed.alias("check"), F.col(f"`{text}`").alias("text"))
    prints = cut_lineage(fingerprinted(slim))
    points = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = pivot_links(points.select("fp"), _groups_for(points.count()), crowd=crowd)
    roots = cut_lineage(components(links))
    rooted = points.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "of_root")
    per_point = rooted.join(named, F.col("root") == F.col("of_root")).select(F.col("fp").alias("of"), "root", "component_id")
    return prints.join(per_point, F.col("fp") == F.col("of")).select("doc_id", "check", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    A null text has no words, like an empty one: fingerprint zero, linked like any other. Rows that repeat
    an id are judged each by its own text. Extra columns are left out, whatever their names. An
    empty table gives an empty result.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    groups = near_groups(docs, doc_id, text, crowd)
    return groups.select(F.col("doc_id").alias(doc_id), hexed.alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """One document of each group, the one with the smallest id, with all columns of ``docs``, whatever their names and types.

    Groups are told apart by their links, not by ids: unlike texts that repeat an id, or that all have none, each
    stay. Of rows that share their own group's smallest id those with the smallest hash of the text stay, and of
    rows that repeat id and text the one with the largest other columns (by its JSON if a column has no order).
    """
    rows = Numbered(docs)
    return rows.back(_drop_near_copies(rows.df, rows[doc_id], rows[text], crowd))


def _drop_near_copies(docs: DataFrame, doc_id: str, text: str, crowd: int) -> DataFrame:
    groups = cut_lineage(near_groups(docs, doc_id, text, crowd, check=True))
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    tied = groups.where(first).groupBy("root").agg(F.min("check").alias("keeps"), F.count("*").alias("n")).where("n > 1")
    several = cut_lineage(tied.select(F.col("root").alias("of_root"), "keeps"))
    same_root = F.col("root") == F.col("of_root")
    out = groups.where(~first)
    ties = not several.isEmpty()
    if ties:
        firsts = groups.where(first).join(several, same_root)
        out = out.select("doc_id", "check").union(firsts.where("check <> keeps").select("doc_id", "check"))
    out = out.select(F.col("doc_id").alias("__g_id"), F.col("check").alias("__g_check")).distinct()
    # Id and text decide the fingerprint, and with it the group.
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__g_id")) & F.xxhash64(F.col(f"`{text}`")).eqNullSafe(F.col("__g_check"))
    kept = docs.join(cut_lineage(out), same, "left_anti")
    if not ties:
        return kept
    repeated = firsts.where("check = keeps").groupBy("doc_id", "check").agg(F.count("*").alias("n")).where("n > 1")
    which = cut_lineage(repeated.select(F.col("doc_id").alias("__g_id"), F.col("check").alias("__g_check")))
    keys = [F.col(f"`{doc_id}`").alias("__id"), F.xxhash64(F.col(f"`{text}`")).alias("__key")]
    once = kept.join(which, same, "left_semi").groupBy(*keys).agg(largest_row(docs).alias("__row")).select("__row.*")
    return kept.join(which, same, "left_anti").unionByName(once)
