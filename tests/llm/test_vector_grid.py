import math

import numpy as np
import pytest

from matchspark.llm import vector_grid as op

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, `a.b` int"


def planted(seed=3, dim=16):
    """Clusters around threshold, copies, other labels with the same vectors, and vectors that link with nothing."""
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        for size in (40, 12, 5, 1, 1, 1, 1, 1):
            center = rng.normal(size=dim)
            for _ in range(size):
                x = center + rng.normal(size=dim) * np.linalg.norm(center) * 0.14 / math.sqrt(dim)
                rows.append([float(v) for v in np.float32(x * rng.choice([1e-3, 1.0, 1e30]))])
        rows[-1] = rows[0]
        yield from ((v, label) for v in rows)
        rows = rows[:3]
    for odd in (None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [1.0] * 3, [1.0] * 3, [2.0]):
        yield odd, 1


def brute(rows, threshold=0.98):
    ok = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1]) for r in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unit = [np.array(r[1], float) / np.linalg.norm(r[1]) if o else None for r, o in zip(rows, ok)]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return sorted(((r[0], n, ids.get(find(i)), r[0] == ids.get(find(i))) for i, (r, n) in enumerate(zip(rows, links))), key=str)


def table(spark):
    rows = [(i * 7 % 1009, v, label, "x", 1) for i, (v, label) in enumerate(planted())]
    # Repeated rows, ids that repeat with another vector, and rows without id.
    rows += [rows[0], (rows[1][0], rows[-20][1], 1, "y", 2), (None, rows[2][1], 0, "z", 3), (None, [5.0, 1.0], 0, "z", 3)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(("block", "cell_rows"), [(4096, 32), (7, 2)])
def test_exact_target_equals_brute_force(spark, block, cell_rows):
    rows, df = table(spark)
    got = op.near_vectors(df, settings=op.GridSettings(target=1.0, block=block, cell_rows=cell_rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_default_target_finds_nearly_all_and_nothing_else(spark):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(60, 64))
    spread = rng.uniform(0.05, 0.16, size=60)
    rows = []
    for i in range(2400):
        c = i % 60
        x = centers[c] + rng.normal(size=64) * np.linalg.norm(centers[c]) * spread[c] / 8
        rows.append((i, [float(v) for v in np.float32(x)], i % 3, "", 0))
    want = brute(rows)
    got = sorted((tuple(r) for r in op.near_vectors(spark.createDataFrame(rows, SCHEMA), settings=op.GridSettings(cell_rows=2)).collect()), key=str)
    links = {r[0]: r[1] for r in want}
    assert all(r[1] <= links[r[0]] for r in got)
    assert sum(r[1] for r in got) >= 0.95 * sum(links.values())


def test_double_vectors_text_ids_and_empty_tables(spark):
    schema = "`my id` string, v array<double>, kind string"
    rows = [("b", [1e200, 1.0], "k"), ("a", [3e-200, 0.0], "k"), ("c", [0.0, 1.0], "k"), (None, None, None)]
    got = op.near_vectors(spark.createDataFrame(rows, schema), "my id", "v", "kind")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [("b", 1, "a", False), ("a", 1, "a", True), ("c", 0, "c", True), (None, 0, None, True)], key=str
    )
    assert op.near_vectors(spark.createDataFrame([], schema), "my id", "v", "kind").collect() == []
    none = spark.createDataFrame([(1, None, 1, "", 0), (2, [0.0], 1, "", 0)], SCHEMA)
    assert sorted(tuple(r) for r in op.near_vectors(none).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_traversal_visits_the_cells_up_to_the_stop():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 8))
    books = [op.learn_codebook(x[:, :4], 5, 5, 0), op.learn_codebook(x[:, 4:], 5, 5, 1)]
    (own_a, near_a), (own_b, near_b) = (op.region_distances(h, c) for h, c in zip((x[:, :4], x[:, 4:]), books))
    for h, c, own, near in ((x[:, :4], books[0], own_a, near_a), (x[:, 4:], books[1], own_b, near_b)):
        squares = ((h[:, None] - c) ** 2).sum(2)
        assert (own == squares.argmin(1)).all() and np.allclose(near[np.arange(50), own], 0)
        k = (own + 1) % len(c)
        bisector = (squares[np.arange(50), k] - squares.min(1)) / (2 * np.linalg.norm(c[k] - c[own], axis=1))
        assert np.allclose(near[np.arange(50), k], bisector**2)


def test_spanning_edges_keep_the_components():
    rng = np.random.default_rng(4)
    for share in (0.01, 0.05, 0.3, 0.9):
        hit = rng.random((40, 30)) < share
        want = op._merged(np.arange(70), *(lambda r, c: (r, c + 40))(*np.nonzero(hit)))
        u, v = op._spanning(hit)
        assert len(u) <= 2 * 70 and hit.any() == bool(len(u))
        assert (op._merged(np.arange(70), u, v + 40) == want).all()
