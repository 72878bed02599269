"""Packed blocks against brute force: sums, neighbours, counts, forests and labels, with copies and ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.plans import blocks, neighbors
from tablelearn.plans.neighbors import distances, mean_silhouette


def plain_silhouette(x, c):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    out = []
    for i, own in enumerate(c):
        size = (c == own).sum()
        if size == 1:
            out.append(0.0)
            continue
        a = d[i, c == own].sum() / (size - 1)
        b = min(d[i, c == o].mean() for o in set(c) if o != own)
        out.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("block_rows", [7, 4_096])
def test_silhouette_with_copies_and_a_cluster_of_one(spark, block_rows):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(150, 3)).round(1), np.zeros((20, 3))])
    c = np.append(rng.integers(0, 4, len(x) - 1), 9)
    rows = spark.createDataFrame([(i, *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, c))], "id long, a double, b double, e double, c int")
    assert mean_silhouette(rows, "id", ["a", "b", "e"], "c", block_rows) == pytest.approx(plain_silhouette(x, c), abs=1e-12)


def test_a_row_is_packed_once(spark):
    """Every row met every block by being copied to it: rows times blocks went through the shuffle."""
    rows = spark.range(1_000).select(F.col("id").alias("key"), F.array(F.rand(1), F.rand(2)).alias("x"))
    held = blocks.packed(rows, "key", {"key": "int64"}, 10).collect()
    assert len(held) == 10 and sorted(k for r in held for k in np.frombuffer(r.key, dtype="int64")) == list(range(1_000))


def test_a_missing_key_is_an_error(spark):
    rows = spark.createDataFrame([(1, [1.0]), (None, [2.0])], "key long, x array<double>")
    with pytest.raises(Exception, match="missing value in column key"):
        blocks.packed(rows, "key", {"key": "int64"}, 1).collect()


@pytest.fixture
def all_meet(monkeypatch):
    """Every search with more than one cell goes by packed blocks of a few rows."""
    monkeypatch.setattr(neighbors, "DENSE_COPIES", 1)
    monkeypatch.setattr(blocks, "TILE_ROWS", 16)
    monkeypatch.setattr(blocks.block_pairs, "__defaults__", (32,))


def spread_points(n, d, seed):
    """Rows far from each other in many columns, a fifth of them copies, some on a grid so that distances tie."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(n - n // 4, d)), rng.integers(0, 2, (n // 4, d)).astype(float)])
    x[: n // 5] = x[n // 5 : 2 * (n // 5)]
    return x[rng.permutation(n)]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
def test_neighbours_of_met_blocks(spark, all_meet, metric):
    x = spread_points(220, 12, 3)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>").repartition(4)
    found = neighbors.knn(rows, rows, 5, metric, block_rows=16)
    assert "Window" in found._jdf.queryExecution().toString()
    got = {(r.query, r["rank"]): (r.neighbor, r.distance) for r in found.collect()}
    d = distances(x, x, metric)
    for i in range(len(x)):
        for rank, j in enumerate(np.lexsort((np.arange(len(x)), d[i]))[:5], 1):
            assert got[i, rank] == (j, d[i, j])
    assert len(got) == 5 * len(x)


def test_density_of_met_blocks(spark, all_meet):
    x = np.unique(spread_points(260, 8, 4), axis=0)
    w = np.arange(len(x)) % 3 + 1
    eps = 2.0
    near = distances(x, x, "euclidean") <= eps
    rows = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, w))], "key long, x array<double>, w long")
    cells = neighbors.PivotCells(rows, "key", "euclidean", 16)
    assert cells.crowded(cells.rows, "key", eps=eps)
    weight = {r.key: r.weight for r in neighbors.weight_within(cells, cells.rows, eps).collect()}
    assert weight == dict(enumerate((near @ w).tolist()))

    keys = [i for i in range(len(x)) if weight[i] >= 5]
    core = cells.rows.where(F.col("key").isin(keys))
    root = {k: k for k in keys}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for r in neighbors.eps_forest(cells, core, eps).collect():
        root[max(top(r.a), top(r.b))] = min(top(r.a), top(r.b))
    want = {k: k for k in keys}
    for _ in keys:
        want = {k: min(want[o] for o in keys if near[k, o]) for k in keys}
    assert {k: top(k) for k in keys} == want

    labelled = core.withColumn("label", F.col("key") % 7)
    others = cells.rows.where(~F.col("key").isin(keys))
    got = {r.key: r.label for r in neighbors.smallest_label_within(cells, others, labelled, eps).collect()}
    want = {i: [k % 7 for k in keys if near[i, k]] for i in range(len(x)) if i not in keys}
    assert got == {i: min(v) for i, v in want.items() if v}


def test_pairs_at_the_limit_are_added_up():
    """A matrix product is off by some last digits; a pair at exactly eps must still be decided by the sum."""
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(40, 64)) + 1_000, rng.normal(size=(50, 64)) + 1_000
    d = distances(a, b, "euclidean")
    for eps in d.ravel()[::37]:
        assert (blocks.within(a, b, "euclidean", eps) == (d <= eps)).all()


def nearest_by_blocks(x, k, size=128):
    """(neighbours, distances) of the rows in a left block, met by right blocks one after the other."""
    ids = np.arange(len(x))
    held = blocks.Nearest({"q": ids[:size], "x": x[:size]}, k, "euclidean")
    for s in range(0, len(x), size):
        held.add({"id": ids[s:s + size], "x": x[s:s + size]})
    return held.id.reshape(-1, k), held.d.reshape(-1, k)


def brute_force(x, k, size=128):
    d = distances(x[:size], x, "euclidean")
    order = np.stack([np.lexsort((np.arange(len(x)), row))[:k] for row in d])
    return order, np.take_along_axis(d, order, axis=1)


def test_candidates_come_from_single_precision(monkeypatch):
    """Every pair was weighed in double precision, in five passes over the distances of a tile."""

    def never(a, b):
        raise AssertionError("double precision for a whole tile")

    x = spread_points(1_000, 64, 6)
    want = brute_force(x, 5)
    monkeypatch.setattr(blocks, "squares", never)
    for moved in (x, x + 3.0, x * 1e-9):
        got = nearest_by_blocks(moved, 5)
        assert (got[0] == want[0]).all() or (got[0] == brute_force(moved, 5)[0]).all()
    assert (nearest_by_blocks(x, 5)[1] == want[1]).all()


@pytest.mark.parametrize("columns", [16, 24])
def test_columns_of_a_tile_do_not_change_the_neighbours(monkeypatch, columns):
    """The right rows were met a whole block at a time, all its distances held at once; F4."""
    monkeypatch.setattr(blocks, "TILE_COLUMNS", columns)
    monkeypatch.setattr(blocks, "TILE_ROWS", 50)
    x = spread_points(700, 64, 8)
    got, want = nearest_by_blocks(x, 5, 300), brute_force(x, 5, 300)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_marked_places():
    rng = np.random.default_rng(9)
    for shape in ((5, 7), (5, 8), (16, 24), (1, 0)):
        near = rng.random(shape) < 0.2
        assert all((a == b).all() for a, b in zip(blocks.marked(near), np.nonzero(near)))


def test_nearest_row_is_one_of_the_nearest():
    rng = np.random.default_rng(10)
    for width in (2, 64):
        a, b = rng.normal(size=(90, width)), rng.normal(size=(40, width))
        d = distances(a, b, "euclidean")
        at, r = blocks.nearest_row(a, b, "euclidean")
        assert (at == d.argmin(axis=1)).all() and (r == d.min(axis=1)).all()


def test_a_block_is_sent_in_single_precision_only_where_that_is_exact(spark):
    """Blocks of single-precision vectors went to Python with 8 bytes a number, for every pair of blocks; F4."""
    rows = spark.createDataFrame([(0, [0.5, -3.0]), (1, [0.1, 2.0]), (2, [float("nan"), 1e300])], "key long, x array<double>")
    for key, width in ((0, 4), (1, 8), (2, 8)):
        held = blocks.packed(rows.where(F.col("key") == key), "key", {"key": "int64"}, 1).first()
        want = np.array(rows.where(F.col("key") == key).first().x)
        got = np.frombuffer(held.x, dtype=np.float32 if held.bytes == 4 else float).astype(float)
        assert held.bytes == width and np.array_equal(got, want, equal_nan=True)


@pytest.mark.parametrize("scale", [1e-40, 1e-6, 1.0, 1e20])
def test_rows_that_single_precision_cannot_tell_apart(scale):
    """Two groups far apart, the rows of each closer together than single precision resolves at that distance."""
    rng = np.random.default_rng(7)
    x = (rng.integers(0, 2, (700, 1)) * 1e6 + rng.normal(size=(700, 16)) * 1e-4) * scale
    got, want = nearest_by_blocks(x, 5), brute_force(x, 5)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
