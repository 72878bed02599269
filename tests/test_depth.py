"""Monotone fits, neighbour information, grown trees, ball sums, landmark embeddings and Ward merging against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.core import load_fitted, save_fitted
from tablelearn.operators import cluster, ensemble, registry
from tablelearn.operators.cluster import MeanShift, _start_distances, agglomerative, distinct_points, merge_tree
from tablelearn.operators.ensemble import CalibratedClassifier
from tablelearn.operators.trees import DecisionTreeClassifier, DecisionTreeRegressor, GrownTreeModel
from tablelearn.operators.tune import leave_one_out
from tablelearn.plans import balls, information, linkage, monotone, nystroem
from tablelearn.plans.growth import grow
from tablelearn.plans.neighbors import points

CUSTOMERS = "/root/testdata/sf0.01/customer.parquet"


def by_definition(w, t):
    """max over starts of min over ends of the mean between them."""
    sw, st = np.concatenate(([0], np.cumsum(w))), np.concatenate(([0], np.cumsum(t)))
    n = len(w)
    mean = np.array([[(st[b + 1] - st[a]) / (sw[b + 1] - sw[a]) if b >= a else np.inf for b in range(n)] for a in range(n)])
    return np.array([max(mean[a, i:].min() for a in range(i + 1)) for i in range(n)])


@pytest.mark.parametrize("kind", ["noise", "falling", "rising", "steps", "long falls"])
@pytest.mark.parametrize("slice_pools", [7, 1000])
def test_monotone_pools_equal_the_definition(spark, kind, slice_pools):
    rng = np.random.default_rng(3)
    n = 120
    y = {"noise": rng.normal(size=n), "falling": -np.arange(n, dtype=float), "rising": np.arange(n, dtype=float), "steps": np.repeat(rng.integers(0, 3, 12), 10).astype(float),
         "long falls": np.concatenate([np.arange(40), -np.arange(40), 30 + np.arange(40)]).astype(float)}[kind]
    w = rng.integers(1, 4, n).astype(float)
    rows = [(float(i), float(w[i]), float(w[i] * y[i])) for i in range(n)]
    split = [(x, a / 2, b / 2) for x, a, b in rows for _ in (0, 1)]  # a point in two rows
    frame = spark.createDataFrame(split, "x double, w double, t double").repartition(5)
    pools = monotone.monotone_pools(frame, slice_pools).orderBy("number").collect()
    got = np.concatenate([[r.t / r.w] * int(r.hi - r.lo + 1) for r in pools])
    assert [r.number for r in pools] == list(range(len(pools))) and np.allclose(got, by_definition(w, w * y))


def test_curves_are_straight_between_corners(spark):
    rng = np.random.default_rng(5)
    x, y = np.sort(rng.normal(size=300)), np.cumsum(rng.random(300)) + rng.normal(size=300)
    frame = spark.createDataFrame([(float(a), 1.0, float(b)) for a, b in zip(x, y)], "x double, w double, t double")
    pieces = monotone.curve_pieces(monotone.monotone_pools(frame), 4)
    asked = np.concatenate([x, rng.normal(size=200) * 2, [-99.0, 99.0]])
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(asked)], "i long, s double")
    got = {r.i: r.p for r in monotone.interpolated(rows, "s", pieces, "p").collect()}
    want = np.interp(asked, x, by_definition(np.ones(300), y))
    assert np.allclose([got[i] for i in range(len(asked))], want)


def test_long_curves_stay_tables(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(i, float(v), int(v + rng.normal() > 0)) for i, v in enumerate(rng.normal(size=400))], "id long, a double, label int")
    make = lambda: CalibratedClassifier(["a"], "label", "id", "GaussianNB", "isotonic", cv=2).fit(rows)
    want = {r.id: r.calibrated_probabilities for r in make().transform(rows).collect()}
    monkeypatch.setattr(ensemble, "CURVE_POINTS", 4)
    model = make()
    assert model.curves[0][0] == {"kind": "isotonic_table"} and len(model.pieces) == 2
    save_fitted(spark, model, str(tmp_path / "m"))
    for m in (model, load_fitted(spark, str(tmp_path / "m"))):
        got = {r.id: r.calibrated_probabilities for r in m.transform(rows).collect()}
        assert all(np.allclose(got[i], want[i]) for i in want)


def psi(x):
    total = 0.0
    while x < 20:
        total, x = total - 1 / x, x + 1
    return total + math.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6)


def class_information(x, c, k=3):
    keep = [i for i in range(len(x)) if sum(v == c[i] for v in c) > 1]
    x, c = [x[i] for i in keep], [c[i] for i in keep]
    n, out = len(x), 0.0
    for i in range(n):
        mine = sorted(abs(x[j] - x[i]) for j in range(n) if j != i and c[j] == c[i])
        need = min(k, len(mine))
        r = mine[need - 1]
        inside = 1 + sum(d < r if r else d == 0 for d in mine)
        m = sum((x[i] - r < v < x[i] + r) if r else v == x[i] for v in x)
        out += psi(inside) - psi(len(mine) + 1) - psi(m)
    return max(0.0, psi(n) + out / n)


@pytest.mark.parametrize("block", [5, 20_000])
def test_class_information_equals_a_plain_reading(spark, monkeypatch, block):
    monkeypatch.setattr(information, "BLOCK_VALUES", block)
    rng = np.random.default_rng(7)
    c = [str(v) for v in rng.integers(0, 3, 150)] + ["alone", "two", "two"]
    cols = [rng.normal(size=153) + [len(v) + float(v == "1") for v in c], rng.integers(0, 4, 153).astype(float), np.round(rng.normal(size=153), 1), np.full(153, 2.0)]
    cells = spark.createDataFrame([(j, c[i], float(col[i])) for j, col in enumerate(cols) for i in range(153)], "j int, c string, x double")
    got = information.with_class(cells)
    assert np.allclose([got[j] for j in range(4)], [class_information(list(col), c) for col in cols])


def test_number_information_equals_a_plain_reading(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=80), [0.5] * 6, np.round(rng.normal(size=30))])
    y = np.concatenate([x[:80] + rng.normal(size=80) * 0.3, [0.25] * 6, np.round(rng.normal(size=30))])
    n, total = len(x), 0.0
    for i in range(n):
        d = np.maximum(np.abs(x - x[i]), np.abs(y - y[i]))
        r = np.sort(np.delete(d, i))[2]
        inside = (d < r).sum() if r else (d == 0).sum()
        counts = [((v > v[i] - r) & (v < v[i] + r)).sum() if r else (v == v[i]).sum() for v in (x, y)]
        total += psi(inside) - psi(counts[0]) - psi(counts[1])
    pairs = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    assert math.isclose(information.with_number(pairs), max(0.0, psi(n) + total / n), abs_tol=1e-9)


def impurity(y, criterion, classes):
    if criterion in ("squared_error", "friedman_mse"):
        return float(((y - y.mean()) ** 2).sum())
    if criterion == "absolute_error":
        return float(np.abs(y - np.median(y)).sum())
    if criterion == "poisson":
        return float(-y.sum() * np.log(y.mean())) if y.sum() > 0 else 0.0
    share = np.bincount(y.astype(int), minlength=classes) / len(y)
    share = share[share > 0]
    return len(y) * float(1 - (share**2).sum() if criterion == "gini" else -(share * np.log2(share)).sum())


def brute_tree(x, y, cuts, criterion, depth, min_split, min_leaf, classes):
    nodes = {}

    def go(i, rows, left):
        here = y[rows]
        nodes[i] = (len(rows), None)
        if left == 0 or len(rows) < max(min_split, 2 * min_leaf) or len(set(here)) < 2:
            return
        best = None
        for j in range(x.shape[1]):
            for t in cuts[j]:
                side = x[rows, j] > t
                if min(side.sum(), (~side).sum()) < min_leaf or (criterion == "poisson" and min(here[side].sum(), here[~side].sum()) <= 0):
                    continue
                cost = impurity(here[side], criterion, classes) + impurity(here[~side], criterion, classes)
                if best is None or cost < best[0] - 1e-9:
                    best = (cost, j, t)
        if best:
            nodes[i] = (len(rows), best[1:])
            side = x[rows, best[1]] > best[2]
            go(2 * i, rows[~side], left - 1)
            go(2 * i + 1, rows[side], left - 1)

    go(1, np.arange(len(y)), depth)
    return nodes


@pytest.mark.parametrize("criterion,min_split,min_leaf", [("squared_error", 40, 1), ("friedman_mse", 2, 5), ("absolute_error", 2, 1), ("poisson", 30, 4), ("gini", 25, 1), ("entropy", 2, 3)])
def test_grown_trees_equal_brute_force(spark, criterion, min_split, min_leaf):
    rng = np.random.default_rng(11)
    x = np.stack([rng.integers(0, 12, 300), rng.integers(0, 3, 300), np.ones(300)], axis=1).astype(float)
    classes = 3 if criterion in ("gini", "entropy") else 0
    y = rng.integers(0, 3, 300).astype(float) if classes else np.floor(x[:, 0] * rng.random(300) + 3 * x[:, 1])
    y = np.where((x[:, 0] > 7) & (rng.random(300) < 0.8), 2.0, y)
    frame = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    nodes = grow(frame, ["a", "b", "c"], "y", criterion, 3, min_split, min_leaf, classes=classes)
    cuts = [(np.unique(v)[1:] + np.unique(v)[:-1]) / 2 for v in x.T]
    want = brute_tree(x, y, cuts, criterion, 3, min_split, min_leaf, classes)
    assert {n["id"]: (n["n"], (n["feature"], n["threshold"]) if "feature" in n else None) for n in nodes} == want
    kind = DecisionTreeClassifier if classes else DecisionTreeRegressor
    model = kind(["a", "b", "c"], "y", 3, min_samples_split=max(3, min_split), criterion=criterion).fit(frame)
    assert isinstance(model, GrownTreeModel) and model.transform(frame).where("prediction IS NULL").count() == 0
    again = GrownTreeModel.from_json(model.to_json())
    assert again.transform(frame).drop("class_probabilities").exceptAll(model.transform(frame).drop("class_probabilities")).count() == 0


def test_grown_trees_of_many_values_and_bad_targets(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=3000)
    y = np.where(x > 0.4, 5.0, 0.0) + rng.normal(size=3000) * 0.1
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "a double, y double")
    model = DecisionTreeRegressor("a", "y", 1, criterion="absolute_error").fit(frame)
    assert abs(model.nodes[0]["threshold"] - 0.4) < 0.08 and model.r2_score > 0.9
    assert abs(model.nodes[2]["value"] - np.median(y[x > model.nodes[0]["threshold"]])) < 0.05
    with pytest.raises(ValueError):
        DecisionTreeRegressor("a", "y", 1, criterion="poisson").fit(frame)


def test_cells_add_up_what_a_ball_holds():
    rng = np.random.default_rng(4)
    for d in (1, 2, 5):
        x = np.concatenate([rng.normal(size=(400, d)), np.round(rng.normal(size=(50, d))), np.zeros((1, d))])
        w = rng.integers(1, 5, len(x))
        centers = np.concatenate([rng.normal(size=(30, d)), x[:20], np.full((1, d), 50.0)])
        total, weight = balls.Cells(x, w, 0.7).sums(centers)
        near = np.sqrt(((centers[:, None] - x[None]) ** 2).sum(axis=2)) <= 0.7
        assert np.allclose(weight, near @ w) and np.allclose(total, near @ (x * w[:, None]))


def test_mean_shift_paths_agree(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.4, (60, 2)) for c in (0, 3, 7)] + [np.zeros((40, 2))])
    frame = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    fit = lambda: np.array(sorted(MeanShift(["a", "b"], "id", bandwidth=1.2).fit(frame).centers))
    inline = fit()
    monkeypatch.setattr(cluster, "INLINE_VALUES", 0)
    assert np.allclose(fit(), inline, atol=1e-9) and len(inline) == 3
    monkeypatch.setattr(balls, "PACK_POINTS", 7)
    assert np.allclose(fit(), inline, atol=1e-9)


def test_landmark_embedding_is_exact_with_all_rows(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(c, 1, (20, 3)) for c in (0, 3)])
    rows = points(spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double"), "id", ["a", "b", "c"], "euclidean")
    got = np.array([r.v for r in nystroem.rbf_embedding(rows, 3, 0.2, 64).orderBy("id").collect()])
    whole = np.exp(-0.2 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    root = np.sqrt(whole.sum(axis=1))
    values, vectors = np.linalg.eigh(whole / root[:, None] / root[None])
    want = vectors[:, ::-1][:, :3] / root[:, None]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)
    few = np.array([r.v for r in nystroem.rbf_embedding(rows, 2, 0.02, 25).orderBy("id").collect()])
    assert abs(np.corrcoef(few[:, 1] / few[:, 0], vectors[:, -2])[0, 1]) > 0.7 or (np.sign(few[:20, 1]) == np.sign(few[0, 1])).mean() > 0.9


@pytest.mark.parametrize("kind", linkage.KINDS)
def test_merges_inside_cells_are_those_of_the_whole_chain(kind):
    """Every cell stops where its border could be nearer than its clusters, wherever the borders are; F10."""
    rng = np.random.default_rng(11)
    x, n, keys = rng.normal(size=(600, 2)) + 50, rng.integers(1, 5, 600).astype(float), rng.permutation(600)
    want = {(a, b): h for a, b, h in linkage.chain_merges(x, n, np.zeros(600), keys, kind)}
    pivots = x[:7]
    home = ((x[:, None] - pivots) ** 2).sum(axis=2).argmin(axis=1)
    left, got = [], {}
    for cell in range(7):
        at = home == cell
        rest, found = linkage.merge_inside(x[at].copy(), n[at].copy(), np.zeros(at.sum()), keys[at].copy(), kind, linkage._borders(pivots, cell))
        left.append(rest)
        got |= {(a, b): h for f in found for a, b, h in zip(*f[:3])}
    assert len(got) > 250 and all(h == pytest.approx(want[k], rel=1e-9) for k, h in got.items())
    rest = linkage.chain_merges(*[np.concatenate(c) for c in zip(*left)], kind)
    assert set(want) == set(got) | {(a, b) for a, b, _ in rest}


def test_few_rounds_over_all_cells(spark, monkeypatch):
    """Each round over all cells merged about a third of the clusters, so 3,000 rows took five of them to come to 400; F10."""
    monkeypatch.setattr(linkage, "_Clusters", lambda *args: pytest.fail("a round over all cells"))
    rng = np.random.default_rng(12)
    rows = spark.createDataFrame([(i, [float(a), float(b)], 1) for i, (a, b) in enumerate(rng.normal(size=(3_000, 2)))], "key long, x array<double>, w long")
    tree = linkage.merges(rows, "ward", finish=400, block_rows=1_000).collect()
    assert len(tree) == 2_999 and len({r.b for r in tree}) == 2_999
    made = {}
    for r in sorted(tree, key=lambda r: r.step):  # a merge stands after those that it builds on
        assert r.step >= max(made.get(r.a, -1), made.get(r.b, -1)) and r.a < r.b
        made[r.a] = r.step


@pytest.mark.parametrize("linkage_,metric", [("ward", "euclidean"), ("average", "cosine")])
def test_rounds_give_the_labels_of_the_full_matrix(spark, monkeypatch, linkage_, metric):
    monkeypatch.setattr(linkage, "FINISH_CLUSTERS", 900)
    frame = spark.read.parquet(CUSTOMERS).select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 100 + 20).alias("a"), (F.col("c_nationkey") + 0.5).alias("b"))
    frame = frame.unionByName(frame.where("id < 30").withColumn("id", F.col("id") + 1_000_000))  # copies
    unique = distinct_points(points(frame, "id", ["a", "b"], metric)).orderBy("key").collect()
    x, w = np.array([r.x for r in unique]), np.array([r.w for r in unique])
    tree = linkage.merges(distinct_points(points(frame, "id", ["a", "b"], metric)), "ward" if linkage_ == "ward" else "average_squared", finish=400, block_rows=200)
    assert tree.count() == len(unique) - 1
    for k in (2, 30):
        label = merge_tree(w, _start_distances(x, w, linkage_, "euclidean", metric), linkage_, k)
        want = {}
        for r, l in zip(unique, label):
            want.setdefault(l, set()).add(r.key)
        got = {}
        for r in linkage.cut_tree(tree, distinct_points(points(frame, "id", ["a", "b"], metric)), k).collect():
            got.setdefault(r.label, set()).add(r.key)
        assert {min(g): g for g in got.values()} == {min(g): g for g in want.values()} and all(label == min(g) for label, g in got.items())
    out = agglomerative(frame, "id", ["a", "b"], 5, linkage_, metric).select("id", "cluster").collect()
    assert len(out) == frame.count() and {r.cluster for r in out} == set(range(5))
    assert len({r.cluster for r in out if r.id in (7, 1_000_007)}) == 1


@pytest.mark.parametrize("rows", [[(1, 0.0)], [(1, 0.0), (2, 0.0)], [(1, 0.0), (2, 5.0), (3, 5.0)]])
def test_ward_of_few_rows(spark, rows):
    frame = spark.createDataFrame(rows, "id long, a double")
    got = {r.id: r.cluster for r in agglomerative(frame, "id", ["a"], 2, "ward").collect()}
    assert got == {i: int(a > 1) for i, a in rows}


@pytest.mark.parametrize("model", ["GaussianNB", "MultinomialNB", "BernoulliNB"])
def test_leave_one_out_bayes_equals_refits(spark, model):
    """Each row against the model fitted on the others; one class has a single row, one a single different value."""
    rng = np.random.default_rng(12)
    rows = [(i, float(a), float(b), "st"[i % 2]) for i, (a, b) in enumerate(rng.integers(0, 4, (24, 2)))]
    rows += [(100, 2.0, 3.0, "one"), (101, 1.0, 0.0, "same"), (102, 1.0, 0.0, "same"), (103, 1.0, 0.0, "same")]
    df = spark.createDataFrame(rows, "id long, a double, b double, label string").repartition(3)
    op = registry.make(model, ["a", "b"], "label")
    got = {r["id"]: r for r in op.leave_one_out(df).collect()}
    scores = {r["id"]: r["test_score"] for r in leave_one_out(df, "id", model, ["a", "b"], "label").collect()}
    for i, *_, label in rows:
        want = registry.make(model, ["a", "b"], "label").fit(df.where(F.col("id") != i)).transform(df.where(F.col("id") == i)).first()
        close = sorted(want["probabilities"])[-2:]
        assert got[i]["prediction"] == want["prediction"] or close[1] - close[0] < 1e-9
        assert scores[i] == float(got[i]["prediction"] == label)
    assert scores[100] == 0.0 and set(got[100].asDict()) == {"id", "a", "b", "label", "prediction"}
    alone = leave_one_out(df.where("id = 100"), "id", model, ["a", "b"], "label").collect()
    assert [(r["id"], r["test_score"]) for r in alone] == [(100, 0.0)]


def test_leave_one_out_ridge_equals_refits(spark):
    rng = np.random.default_rng(13)
    x, y = rng.normal(size=(30, 2)), rng.normal(size=30)
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "id long, a double, b double, y double")
    for intercept in (True, False):
        got = {r["id"]: r["test_score"] for r in leave_one_out(df, "id", "Ridge", ["a", "b"], "y", params={"alpha": 3.0, "fit_intercept": intercept}).collect()}
        for i in range(30):
            rest = np.arange(30) != i
            mx, my = (x[rest].mean(axis=0), y[rest].mean()) if intercept else (np.zeros(2), 0.0)
            w = np.linalg.solve((x[rest] - mx).T @ (x[rest] - mx) + 3 * np.eye(2), (x[rest] - mx).T @ (y[rest] - my))
            assert np.isclose(got[i], -((y[i] - my - (x[i] - mx) @ w) ** 2))
