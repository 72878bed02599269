"""Distributed building blocks against brute force, with hot keys and forced large-data paths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.operators.cluster import MeanShift, agglomerative, dbscan, distinct_points
from tablelearn.operators.metrics import clustering_metrics
from tablelearn.plans.components import components
from tablelearn.plans.moments import moments
from tablelearn.plans.neighbors import knn, mean_silhouette, points
from tablelearn.plans.quantiles import exact_quantiles
from tablelearn.plans.ranking import running_total
from tablelearn.plans import farfield, neighbors, skew


def frame(spark, x, **extra):
    cols = [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r), *[extra[k][i] for k in extra]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, ["id", *cols, *extra]).repartition(5), cols


def hot_points(n, d, seed=0):
    """A third of the rows are copies of one point."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(0, 10, (n, d)).round(1)
    x[rng.permutation(n)[: n // 3]] = x[0]
    return x


def brute_dbscan(x, eps, min_samples, dist):
    near = dist <= eps
    core = near.sum(axis=1) >= min_samples
    label = np.full(len(x), -1)
    number = 0
    for i in range(len(x)):
        if not core[i] or label[i] >= 0:
            continue
        todo = [i]
        label[i] = number
        while todo:
            p = todo.pop()
            for q in np.flatnonzero(near[p] & core & (label < 0)):
                label[q] = number
                todo.append(q)
        number += 1
    for i in np.flatnonzero(~core):
        hits = label[near[i] & core]
        label[i] = hits.min() if len(hits) else -1
    return label, core


def pairwise(x, metric):
    gap = np.abs(x[:, None, :] - x[None, :, :])
    return {"euclidean": np.sqrt((gap**2).sum(axis=2)), "manhattan": gap.sum(axis=2), "chebyshev": gap.max(axis=2)}[metric]


@pytest.mark.parametrize("d,metric,eps", [(1, "euclidean", 0.15), (2, "euclidean", 0.7), (2, "manhattan", 0.8), (3, "chebyshev", 1.1), (4, "euclidean", 2.0)])
def test_dbscan_matches_brute_force(spark, d, metric, eps):
    x = hot_points(160, d)
    df, cols = frame(spark, x)
    got = {r.id: (r.cluster, r.is_core_sample) for r in dbscan(df, "id", cols, eps, 4, metric).collect()}
    label, core = brute_dbscan(x, eps, 4, pairwise(x, metric))
    assert got == {i: (int(label[i]), bool(core[i])) for i in range(len(x))}


def test_dbscan_small_slices_and_distributed_components(spark, monkeypatch):
    from tablelearn.plans import density

    monkeypatch.setattr(density, "SLICE_ROWS", 3)
    monkeypatch.setattr(density, "components", lambda e: components(e, finish_edges=0))
    x = hot_points(120, 2, 3)
    df, cols = frame(spark, x)
    got = {r.id: r.cluster for r in dbscan(df, "id", cols, 0.8, 5).collect()}
    label, _core = brute_dbscan(x, 0.8, 5, pairwise(x, "euclidean"))
    assert got == {i: int(v) for i, v in enumerate(label)}


def test_components_on_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(500, 501)]
    df = spark.createDataFrame(edges, "a long, b long")
    for finish in (0, 1000):
        got = {r.node: r.comp for r in components(df, finish).collect()}
        assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 500: 500, 501: 500}


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_with_hot_copies_and_tiny_blocks(spark, metric):
    x = hot_points(150, 3, 1)
    df, cols = frame(spark, x)
    rows = points(df, "id", cols, metric)
    got = {}
    for r in knn(rows, rows, 4, metric, block_rows=16).collect():
        got.setdefault(r["query"], []).append((r["rank"], r.neighbor, round(r.distance, 9)))
    dist = pairwise(x, metric)
    for i in range(len(x)):
        order = sorted(range(len(x)), key=lambda j: (dist[i, j], j))[:4]
        assert [n for _, n, _ in sorted(got[i])] == order


def test_exact_quantiles_by_bucket_counting(spark):
    x = np.concatenate([np.full(300, 5.0), np.random.default_rng(0).exponential(100, 600), [-1e9, 1e9]])
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(6)
    marks = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    for limit in (10, 10_000):
        found, n = exact_quantiles(df, ["v"], marks, direct_rows=limit)
        assert n == len(x)
        assert np.allclose(found[0], np.quantile(x, marks), rtol=1e-12)


def test_running_total_and_hot_join(spark, monkeypatch):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v")).repartition(7)
    got = {r.id: r.t for r in running_total(df, ["id"], "v", "t").collect()}
    want = np.concatenate([[0], np.cumsum(np.arange(1000) % 7)[:-1]])
    assert got == {i: int(v) for i, v in enumerate(want)}
    monkeypatch.setattr(skew, "SMALL_ROWS", 10)
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    right = spark.range(2500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    fast = skew.hot_safe_join(left, right, ["k"], "left")
    assert sorted(map(tuple, fast.select("id", "k", "v").collect()), key=str) == sorted(map(tuple, left.join(right, ["k"], "left").select("id", "k", "v").collect()), key=str)


@pytest.mark.parametrize("d", [3, 7, 14])
def test_moments_match_numpy_with_large_offsets(spark, d):
    x = np.random.default_rng(2).normal(1e6, 1.0, (400, d))
    df, cols = frame(spark, x)
    m = moments(df, cols)
    assert m.n == 400 and np.allclose(m.mean, x.mean(axis=0), rtol=1e-12)
    assert np.allclose(m.cross, (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), rtol=1e-6, atol=1e-4)


def test_silhouette_blocks(spark):
    x = hot_points(90, 2, 5)
    label = (x[:, 0] > 5).astype(int) + (x[:, 1] > 8)
    df, cols = frame(spark, x, c=[int(v) for v in label])
    dist = pairwise(x, "euclidean")
    values = []
    for i in range(len(x)):
        own = (label == label[i]) & (np.arange(len(x)) != i)
        a = dist[i, own].mean() if own.any() else 0.0
        b = min(dist[i, label == c].mean() for c in set(label) if c != label[i])
        values.append((b - a) / max(a, b) if own.any() and max(a, b) else 0.0)
    assert np.isclose(mean_silhouette(df, "id", cols, "c", block_rows=13), np.mean(values))
    assert clustering_metrics(df.withColumn("one", F.lit(1)), cols, "one").first().error.startswith("need")


def far_points(kind, rng, n):
    if kind == "lines":
        x = np.column_stack([rng.uniform(-1, 10, n), rng.integers(0, 25, n)])
    elif kind == "tails":
        x = rng.standard_cauchy((n, 2))
    elif kind == "offset":
        x = 1e7 + rng.normal(size=(n, 2))
    elif kind == "one column":
        x = rng.normal(size=(n, 1))
    else:
        x = rng.integers(0, 40, (n, 2)).astype(float)  # many copies
    return x


@pytest.mark.parametrize("kind", ["lines", "tails", "offset", "one column", "grid"])
def test_silhouette_of_many_rows_without_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(farfield, "LEAF_ROWS", 32)
    rng = np.random.default_rng(6)
    x = far_points(kind, rng, 3000)
    label = (x[:, 0] > np.median(x[:, 0])).astype(int) + 2 * (rng.uniform(size=len(x)) < 0.1)
    label[:1] = 9  # alone
    df, cols = frame(spark, x, c=[int(v) for v in label])
    dist = np.sqrt(sum((x[:, None, j] - x[None, :, j]) ** 2 for j in range(x.shape[1])))
    codes, own = np.unique(label, return_inverse=True)
    sums = np.stack([dist[:, own == c].sum(axis=1) for c in range(len(codes))], axis=1)
    size, at = np.bincount(own).astype(float), np.arange(len(x))
    a, far = sums[at, own] / np.maximum(size[own] - 1, 1), sums / size
    far[at, own] = np.inf
    b = far.min(axis=1)
    want = np.where(size[own] == 1, 0.0, (b - a) / np.maximum(a, b)).mean()
    with monkeypatch.context() as patch:
        patch.setattr(neighbors, "block_pairs", None)
        assert np.isclose(mean_silhouette(df, "id", cols, "c", far_rows=100), want, rtol=1e-10, atol=1e-12)
    assert np.isclose(mean_silhouette(df, "id", cols, "c"), want, rtol=1e-10, atol=1e-12)


@pytest.mark.parametrize("kind,share", [("lines", 0.15), ("tails", 0.5), ("one column", 0.1)])
def test_far_sums_meet_every_leaf_once(kind, share):
    rng = np.random.default_rng(7)
    x, weights = far_points(kind, rng, 6000), rng.integers(1, 4, (6000, 2)).astype(float)
    tree = farfield.Tree(x[::3], 10)
    at, low, high, held = tree.find(x), {}, {}, {}
    for leaf in tree.leaf:
        mine = at == leaf
        low[leaf], high[leaf] = x[mine].min(axis=0), x[mine].max(axis=0)
        held[leaf] = farfield.moments(x[mine] - low[leaf], weights[mine], high[leaf] - low[leaf])
    tree.fill(low, high, held)
    assert set(at) == set(tree.leaf) and len(tree.leaf) > 150
    target, source, way = tree.seen_from(tree.leaf)
    assert (way == farfield.NEAR).sum() < share * len(tree.leaf) ** 2  # before, all of them

    def under(node):
        return [node] if tree.left[node] == node else under(tree.left[node]) + under(tree.right[node])

    for leaf in tree.leaf[::20]:
        seen = target == leaf
        nodes, ways = source[seen], way[seen]
        assert sorted(v for n in nodes for v in under(n)) == tree.leaf.tolist()
        far = np.isin(at, [v for n in nodes[ways != farfield.NEAR] for v in under(n)])
        want = np.sqrt(((x[at == leaf][:, None] - x[far][None]) ** 2).sum(axis=2)) @ weights[far]
        assert np.allclose(tree.far_sums(x[at == leaf], leaf, nodes, ways), want, rtol=1e-11)


def brute_merge(x, k, linkage):
    groups = [[i] for i in range(len(x))]
    dist = pairwise(x, "euclidean")
    while len(groups) > k:
        best = None
        for a in range(len(groups)):
            for b in range(a + 1, len(groups)):
                d = dist[np.ix_(groups[a], groups[b])]
                if linkage == "ward":
                    p, q = x[groups[a]], x[groups[b]]
                    v = 2 * len(p) * len(q) / (len(p) + len(q)) * ((p.mean(axis=0) - q.mean(axis=0)) ** 2).sum()
                else:
                    v = {"single": d.min(), "complete": d.max(), "average": d.mean()}[linkage]
                if best is None or v < best[0]:
                    best = (v, a, b)
        groups[best[1]] += groups.pop(best[2])
    return {i: n for n, g in enumerate(sorted(groups, key=min)) for i in g}


@pytest.mark.parametrize("linkage", ["ward", "complete", "average", "single"])
def test_agglomerative_matches_brute_force(spark, linkage):
    x = np.random.default_rng(4).normal(0, 1, (40, 2))
    x[5] = x[7]
    df, cols = frame(spark, x)
    got = {r.id: r.cluster for r in agglomerative(df, "id", cols, 4, linkage).collect()}
    assert got == brute_merge(x, 4, linkage)


def test_single_linkage_by_bisection(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 1, (10, 2)) for c in (0, 60, 100)])
    df, cols = frame(spark, x)
    got = {r.id: r.cluster for r in agglomerative(df, "id", cols, 3, "single", micro=5).collect()}
    assert got == brute_merge(x, 3, "single")


def test_mean_shift_inline_and_block_paths_agree(spark, monkeypatch):
    from tablelearn.operators import cluster

    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.2, (25, 2)) for c in (0, 4, 8)])
    df, cols = frame(spark, x)
    few = MeanShift(cols, "id", bandwidth=1.5).fit(df)
    monkeypatch.setattr(cluster, "INLINE_SEEDS", 10)
    many = MeanShift(cols, "id", bandwidth=1.5).fit(df)
    assert few.n_clusters == many.n_clusters == 3
    assert np.allclose(sorted(few.centers), sorted(many.centers), atol=0.05)
    labels = {r.id: r.cluster for r in many.transform(df).collect()}
    assert len({labels[i] for i in range(25)}) == 1 and len(set(labels.values())) == 3


def test_distinct_points_counts_copies(spark):
    x = hot_points(60, 2, 9)
    df, cols = frame(spark, x)
    rows = distinct_points(points(df, "id", cols, "euclidean")).collect()
    assert sum(r.w for r in rows) == 60 and len(rows) == len({tuple(v) for v in x})


def test_hot_join_leaves_null_keys_alone(spark, monkeypatch):
    monkeypatch.setattr(skew, "SMALL_ROWS", 10)
    left = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"), "id")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k long, v string")
    for how in ("inner", "left"):
        got = sorted(map(str, skew.hot_safe_join(left, right, ["k"], how).select("id", "k", "v").collect()))
        assert got == sorted(map(str, left.join(right, ["k"], how).select("id", "k", "v").collect()))
