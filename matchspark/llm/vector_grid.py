"""Near-duplicate vectors by an inverted multi-index: a product grid of two codebooks, nearest cells first.

1. Rows of equal label and equal vector are one class with a number of copies. A bounded sample of classes teaches one
   codebook per half of the vectors; a class lies in the cell named by its nearest centroid of each half.
2. A vector visits cells by the growing sum of two squared distances, one per half, from its half to the region of the
   cell's centroid (the bisector of that centroid and its own). The multi-sequence order over the two sorted lists
   ends at a sum ``stop``, so it visits the staircase of all cells up to that sum. ``stop`` is the sum within which the
   target share of partners lies: of pairs made at exactly the threshold, and of the sample's own weakest pairs. No
   partner can lie beyond ``2 - 2 * threshold``, with which the search is exact.
3. Of two cells only the one with the smaller number visits the other, so a pair is met once. Rows are dealt by label
   and the cell's first half; a vector goes to each such bucket once, with the bits of the second halves it visits there. Buckets
   that are too large for a task are cut into blocks of owners and visitors, and all pairs of blocks are compared.
4. Pairs met are verified by their cosine in double precision. A task returns a row per class that has a link there: the number of
   links and one class it hangs together with; pairs are never written. Components follow from these rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from matchspark.llm.common import workers_find_package
from matchspark.llm.components import components
from matchspark.session import cut_lineage

#: Rows of a matrix of distances to all centroids, and rows a side of one product of vectors.
STEP = 1024
#: The sample's bytes at most; long vectors make it smaller.
SAMPLE_BYTES = 64_000_000


@dataclass(frozen=True)
class GridSettings:
    """Cosine from which on vectors link; share of links to be found; rows of the sample; mean rows of a cell in the
    largest label; classes a side of one task; rounds of codebook learning; seed."""

    threshold: float = 0.98
    target: float = 0.99
    sample: int = 8192
    cell_rows: int = 32
    block: int = 4096
    rounds: int = 12
    seed: int = 7


# -- vectors ------------------------------------------------------------------------------------


def decoded(vectors: pa.Array, width: int, dim: int) -> np.ndarray:
    """Vectors of one length as doubles, each scaled by a power of two so that no square overflows or vanishes."""
    raw = np.frombuffer(b"".join(vectors.to_pylist()), np.float32 if width == 4 else np.float64).reshape(-1, dim)
    raw = raw.astype(np.float64)
    _, exponent = np.frexp(np.abs(raw).max(axis=1))
    return np.ldexp(raw, -exponent[:, None])


def _halves(vectors: list[bytes], width: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the unit vectors, each filled up with zeros to ``half`` places. Lengths may differ."""
    first, second = np.zeros((len(vectors), half)), np.zeros((len(vectors), half))
    dims = np.array([len(v) // width for v in vectors])
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        x = decoded(pa.array([vectors[i] for i in at]), width, dim)
        x /= np.linalg.norm(x, axis=1)[:, None]
        first[at, : dim // 2] = x[:, : dim // 2]
        second[at, : dim - dim // 2] = x[:, dim // 2 :]
    return first, second


# -- codebooks and the traversal ------------------------------------------------------------------


def learn_codebook(x: np.ndarray, size: int, rounds: int, seed: int) -> np.ndarray:
    """At most ``size`` distinct centroids by Lloyd's rounds from rows chosen at random."""
    rng = np.random.default_rng(seed)
    points = np.unique(x, axis=0)
    centroids = points[rng.choice(len(points), min(size, len(points)), replace=False)]
    for _ in range(rounds):
        own = np.concatenate([_squares(x[i : i + STEP], centroids).argmin(1) for i in range(0, len(x), STEP)])
        counts = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return np.unique(centroids, axis=0)


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2.0 * (x @ centroids.T) + (centroids * centroids).sum(1)


def region_distances(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and squared distances from the row to the bisectors with all others."""
    squares = _squares(x, centroids)
    own = squares.argmin(1)
    apart = np.sqrt(np.maximum(_squares(centroids, centroids), 0.0))
    between = apart[own]
    gap = squares - squares[np.arange(len(x)), own][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(between > 0, gap / (2.0 * between), np.inf)
    out[np.arange(len(x)), own] = 0.0
    return own, out * out


@dataclass(frozen=True)
class ProductGrid:
    """Codebooks of both halves, places per half, bytes per number, and the sum at which the traversal ends."""

    first: np.ndarray
    second: np.ndarray
    half: int
    width: int
    stop: float

    def visits(self, vectors: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Own first and second half of every vector, then per visit: vector, first half, flags of the second halves.

        Visited are cells with a sum of squared distances up to ``stop`` and with a number not below the own cell's.
        """
        halves = _halves(vectors, self.width, self.half)
        (own_a, near_a), (own_b, near_b) = region_distances(halves[0], self.first), region_distances(halves[1], self.second)
        who, a = np.nonzero((near_a <= self.stop) & (np.arange(len(self.first)) >= own_a[:, None]))
        flags = near_b[who] <= (self.stop - near_a[who, a])[:, None]
        flags &= (a > own_a[who])[:, None] | (np.arange(len(self.second)) >= own_b[who][:, None])
        some = flags.any(1)
        return own_a, own_b, who[some], a[some], flags[some]


def _sums_needed(grid: ProductGrid, x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Sum at which the traversal of each pair's vector with the smaller cell reaches the other one's cell."""
    out = np.zeros(len(x))
    sides = [[region_distances(h, c) for h, c in zip(_halves(v, grid.width, grid.half), (grid.first, grid.second))] for v in (x, y)]
    cell = [a[0] * len(grid.second) + b[0] for a, b in sides]
    rows = np.arange(len(x))
    for here, there, goes in ((0, 1, cell[0] <= cell[1]), (1, 0, cell[1] < cell[0])):
        (_, near_a), (_, near_b) = sides[here]
        need = near_a[rows, sides[there][0][0]] + near_b[rows, sides[there][1][0]]
        out[goes] = need[goes]
    return out


def _weakest_partners(x: np.ndarray, labels: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of every row that has a partner of its label, and of its partner with the smallest cosine."""
    who, partner = [], []
    for i in range(0, len(x), STEP):
        cos = x[i : i + STEP] @ x.T
        linked = (cos >= threshold) & (labels[i : i + STEP, None] == labels)
        linked[np.arange(len(cos)), np.arange(i, i + len(cos))] = False
        some = np.flatnonzero(linked.any(1))
        who.append(some + i)
        partner.append(np.where(linked[some], cos[some], 2.0).argmin(1))
    return np.concatenate(who), np.concatenate(partner)


def learn_grid(sample: list[tuple[int, bytes]], largest: int, longest: int, width: int, settings: GridSettings) -> ProductGrid:
    """Codebooks and stop from (label number, vector) rows; ``largest`` is the size of the largest label."""
    labels, vectors = np.array([r[0] for r in sample]), [r[1] for r in sample]
    half = (longest + 1) // 2
    size = min(1024, max(2, math.ceil(math.sqrt(largest / settings.cell_rows))))
    halves = _halves(vectors, width, half)
    books = [learn_codebook(h, size, settings.rounds, settings.seed + k) for k, h in enumerate(halves)]
    grid = ProductGrid(books[0], books[1], half, 8, math.inf)
    unit = np.hstack(halves)
    # A partner at exactly the threshold, in a random direction.
    turn = np.random.default_rng(settings.seed + 2).normal(size=unit.shape) * (unit != 0)
    turn -= (turn * unit).sum(1)[:, None] * unit
    length = np.linalg.norm(turn, axis=1)
    able = length > 1e-9
    made = settings.threshold * unit + math.sqrt(1 - settings.threshold**2) * turn / np.where(able, length, 1.0)[:, None]
    pairs = [(unit[able], made[able])]
    who, partner = _weakest_partners(unit, labels, settings.threshold)
    pairs.append((unit[who], unit[partner]))
    most = 2.0 - 2.0 * settings.threshold
    stop = 0.0
    for x, y in pairs:
        if len(x):
            # Both halves have equal places here, so a row of bytes splits where the halves meet.
            needed = _sums_needed(grid, [r.tobytes() for r in x], [r.tobytes() for r in y])
            stop = max(stop, float(np.quantile(needed, settings.target, method="higher")))
    return ProductGrid(books[0], books[1], half, width, min(stop, most) if settings.target < 1 else most)


# -- the index on Spark ---------------------------------------------------------------------------


def _vectors(rows: DataFrame, vec_id: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """(id, label, vec) of every row, and bytes per number. ``vec`` is null where the row links with nothing."""
    kind = rows.schema[vector].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    slim = rows.select(
        F.col(f"`{vec_id}`").alias("id"),
        F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").cast("array<float>" if single else "array<double>").alias("vector"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in slim.schema.fields[:2]] + [T.StructField("vec", T.BinaryType())])
    arrow, number = to_arrow_schema(schema), np.float32 if single else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vectors = batch.column(1), batch.column(2)
            vecs: list[bytes | None] = []
            for known, v in zip(labels.is_valid().to_pylist(), vectors):
                values = v.values if known else None
                if values is None or not len(values) or values.null_count:
                    vecs.append(None)
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(number, copy=False)
                vecs.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
            columns = [batch.column(0).cast(arrow.field(0).type), labels.cast(arrow.field(1).type), pa.array(vecs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return slim.mapInArrow(run, schema), 4 if single else 8


def _visited(classes: DataFrame, grid: ProductGrid, count: bool) -> DataFrame:
    """Owners and visitors of every bucket (label, dim, a); only their numbers if ``count``."""
    label = T.StructField("label", classes.schema["label"].dataType)
    longs = [T.StructField(n, T.LongType()) for n in (("dim", "a", "owners", "visitors") if count else ("dim", "a", "class", "copies", "cell"))]
    more = [] if count else [T.StructField("flags", T.BinaryType()), T.StructField("vec", T.BinaryType())]
    schema = T.StructType([label, *longs, *more])
    arrow = to_arrow_schema(schema)
    cells = len(grid.second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP):
                batch = whole.slice(start, STEP)
                label, number, copies, vec = (batch.column(i) for i in range(4))
                vectors = vec.to_pylist()
                dim = np.array([len(v) // grid.width for v in vectors], np.int64)
                own_a, own_b, who, a, flags = grid.visits(vectors)
                rows = np.arange(len(vectors))
                at = np.concatenate([rows, who])
                bucket, of = np.concatenate([own_a, a]), pa.array(at)
                if count:
                    owner = (np.arange(len(at)) < len(rows)).astype(np.int64)
                    made = [label.take(of), dim[at], bucket, owner, 1 - owner]
                else:
                    cell = np.concatenate([own_b, (own_a * cells + own_b)[who]])
                    bits = [None] * len(rows) + [f.tobytes() for f in np.packbits(flags, axis=1)]
                    made = [label.take(of), dim[at], bucket, number.take(of), copies.take(of), cell, bits, vec.take(of)]
                columns = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(made, arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return classes.select("label", "class", "copies", "vec").mapInArrow(run, schema)


def _in_blocks(dealt: DataFrame, hot: DataFrame) -> DataFrame:
    """Every owner beside every visitor of its bucket, in blocks (o, v) that a task can hold."""
    none = F.lit(0).cast("long")
    if hot.isEmpty():
        return dealt.withColumns({"o": none, "v": none})
    keys = ["label", "dim", "a"]
    sized = dealt.join(hot, keys, "left").na.fill(1, ["o_blocks", "v_blocks"])
    owns, draw = F.col("flags").isNull(), F.xxhash64("class")
    others = F.sequence(none, F.when(owns, F.col("v_blocks")).otherwise(F.col("o_blocks")) - 1)
    spread = sized.withColumn("other", F.explode(others)).withColumns(
        {
            "o": F.when(owns, F.pmod(draw, F.col("o_blocks"))).otherwise(F.col("other")),
            "v": F.when(owns, F.col("other")).otherwise(F.pmod(draw, F.col("v_blocks"))),
        }
    )
    return spread.drop("other", "o_blocks", "v_blocks")


def _merged(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node number reachable from every node over the edges (u, v)."""
    while True:
        least = np.minimum(labels[u], labels[v])
        after = labels.copy()
        np.minimum.at(after, u, least)
        np.minimum.at(after, v, least)
        after = after[after]
        if np.array_equal(after, labels):
            return labels
        labels = after


def _spanning(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (row, column) with the same components as ``hit``, fewer than three per row and column if there are many."""
    if hit.sum() <= 2 * sum(hit.shape):
        return np.nonzero(hit)
    rows, columns = np.arange(hit.shape[0]), np.full(hit.shape[1], hit.shape[0])
    none = hit.shape[0]
    while True:
        # The smallest row number known to each column, then to each row, until nothing changes.
        columns = np.minimum(columns, np.where(hit, rows[:, None], none).min(0))
        after = np.minimum(rows, np.where(hit, columns, none).min(1))
        if np.array_equal(after, rows):
            break
        rows = after
    # Every column hangs on the head row of its component, and every row on a column with that head.
    used = np.flatnonzero(hit.any(0))
    some = np.flatnonzero(hit.any(1))
    return np.concatenate([columns[used], some]), np.concatenate([used, hit[some].argmax(1)])


def linked_in_block(table: pa.Table, dim: int, grid: ProductGrid, threshold: float) -> pa.Table:
    """(class, links, head) of every class with a link in this block; ``links`` counts copies."""
    empty = pa.schema([("class", pa.int64()), ("links", pa.int64()), ("head", pa.int64())])
    owns = np.array(table.column("flags").is_null())
    if owns.all() or not owns.any():
        return empty.empty_table()
    number, copies, cell = (table.column(c).to_numpy() for c in ("class", "copies", "cell"))
    vectors = decoded(table.column("vec").combine_chunks(), grid.width, dim)
    length = np.linalg.norm(vectors, axis=1)
    owners, visitors = np.flatnonzero(owns), np.flatnonzero(~owns)
    owners = owners[np.argsort(cell[owners], kind="stable")]
    cells = len(grid.second)
    bits = np.frombuffer(b"".join(table.column("flags").take(pa.array(visitors)).to_pylist()), np.uint8).reshape(len(visitors), -1)
    a = table.column("a")[0].as_py()
    links, heads, tails = np.zeros(len(number), np.int64), [], []
    found, starts = np.unique(cell[owners], return_index=True)
    for b, lo, hi in zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(owners)]):
        asking = visitors[(bits[:, b >> 3] >> (7 - (b & 7)) & 1).astype(bool)]
        for i in range(0, len(asking), STEP):
            x = asking[i : i + STEP]
            home = cell[x] == a * cells + b
            for j in range(lo, hi, STEP):
                y = owners[j : min(j + STEP, hi)]
                cos = (vectors[x] @ vectors[y].T) / (length[x][:, None] * length[y])
                hit = cos >= threshold
                hit &= ~home[:, None] | (number[x][:, None] < number[y])
                if hit.any():
                    links[x] += hit @ copies[y]
                    links[y] += copies[x] @ hit
                    u, v = _spanning(hit)
                    heads.append(x[u])
                    tails.append(y[v])
    if not heads:
        return empty.empty_table()
    root = _merged(np.arange(len(number)), np.concatenate(heads), np.concatenate(tails))
    some = np.flatnonzero(links)
    return pa.table([pa.array(number[some]), pa.array(links[some]), pa.array(number[root[some]])], schema=empty)


def _links(classes: DataFrame, grid: ProductGrid, settings: GridSettings) -> DataFrame:
    """(class, links, head) rows of all blocks."""
    sizes = _visited(classes, grid, count=True).groupBy("label", "dim", "a").agg(F.sum("owners").alias("owners"), F.sum("visitors").alias("visitors"))
    blocks = lambda c: F.ceil(F.col(c) / F.lit(settings.block)).cast("long")
    hot = sizes.where(F.greatest("owners", "visitors") > settings.block).select(
        "label", "dim", "a", blocks("owners").alias("o_blocks"), blocks("visitors").alias("v_blocks")
    )
    dealt = _in_blocks(_visited(classes, grid, count=False), cut_lineage(hot))
    threshold = settings.threshold

    def verify(key: tuple, table: pa.Table) -> pa.Table:
        return linked_in_block(table, key[1].as_py(), grid, threshold)

    return dealt.groupBy("label", "dim", "a", "o", "v").applyInArrow(verify, "class long, links long, head long")


def near_vectors(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", settings: GridSettings = GridSettings()
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``rows``.

    Rows link if their labels are equal, their vectors have the same length and a cosine of at least ``threshold``;
    no other pair ever counts, and about ``target`` of the links of different vectors are found (all with a target of
    1). Equal vectors always link. A null label, a null, empty or zero vector, and one that holds a null or a
    number that isn't finite link with nothing: no links, a component of its own. ``component_id`` is the smallest id
    reachable, nulls aside; it is null if all are null. Rows that repeat an id are vectors of their own. ``kept`` says that
    the id is its component's. Extra columns are left out, whatever their names. An empty table gives an empty result.
    """
    workers_find_package(rows.sparkSession)
    given, width = _vectors(rows, vec_id, vector, label)
    same = given.where("vec IS NOT NULL").groupBy("label", "vec").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    classes = cut_lineage(same.withColumn("class", F.monotonically_increasing_id()))
    count, largest, longest = (
        classes.groupBy("label").agg(F.count("*").alias("n"), F.max(F.length("vec")).alias("longest"))
        .agg(F.sum("n"), F.max("n"), F.max("longest")).first()
    )
    result = [F.col("id").alias(vec_id)]
    if not count:
        return given.select(*result, F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    wanted = max(1, min(settings.sample, SAMPLE_BYTES // longest))
    draw = F.pmod(F.xxhash64("vec", F.lit(settings.seed)), F.lit(1 << 40))
    drawn = classes if count <= wanted else classes.where(draw < (1 << 40) * wanted // count)
    picked = drawn.select(F.xxhash64("label"), "vec").collect() or classes.select(F.xxhash64("label"), "vec").limit(1).collect()
    # The order of the rows read decides the first centroids.
    grid = learn_grid(sorted(map(tuple, picked)), largest, longest // width, width, settings)
    hits = cut_lineage(_links(classes, grid, settings))
    counts = hits.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(hits.select(F.col("class").alias("u"), F.col("head").alias("v"))).select(F.col("node").alias("class"), "root")
    key = F.unhex(F.sha2("vec", 256)).alias("key")
    linked = (
        classes.select("class", F.col("label").alias("of_label"), key, "first_id", "copies")
        .join(counts, "class", "left").where("copies > 1 OR links IS NOT NULL").join(roots, "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    linked = cut_lineage(linked)
    named = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = linked.join(named, "root").select(
        "of_label", F.col("key").alias("of_key"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    at = given.select("id", "label", key)
    joined = at.join(found, (F.col("key") == F.col("of_key")) & (F.col("label") == F.col("of_label")), "left")
    component = F.when(F.col("of_key").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(
        *result, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )
