import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.llm import hardneg


def brute(rows, every=50):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        mine = (label, list(v))
        kept[i] = min(kept.get(i, mine), mine)
    ints = {i: [int(np.floor(256.0 * x)) for x in v] for i, (_, v) in kept.items()}
    score = lambda a, b: sum(x * y for x, y in zip(ints[a], ints[b]))
    out = []
    for a in kept:
        if a % every:
            continue
        same = sorted((-score(a, b), b) for b in kept if b != a and kept[b][0] == kept[a][0])[:5]
        other = sorted((-score(a, b), b) for b in kept if kept[b][0] != kept[a][0])
        for s, p in same:
            fit = [(t, n) for t, n in other if 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n) in enumerate(fit)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label) for i, label, v in rows], "vec_id long, embedding array<double>, label int")


def got(spark, rows, **kw):
    return sorted(tuple(r) for r in hardneg.hard_negatives(frame(spark, rows), **kw).collect())


def some(n=900, dims=20, seed=2):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    scale = np.exp(rng.normal(size=dims))
    return [(i, int(rng.integers(0, 4)), [float(x) for x in (centers[rng.integers(0, 6)] + rng.normal(size=dims)) * scale * rng.choice([1, 0.3, 2])]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = some()
    want = brute(rows)
    assert len(want) > 100 and got(spark, rows) == want


def test_small_pieces_give_the_same(spark, monkeypatch):
    rows = some(400, 9, 5)
    for name, value in {"ANCHOR_ROWS": 3, "SLICE_ROWS": 90, "QUERY_ROWS": 2, "INDEX_ROWS": 16, "STEP": 2}.items():
        monkeypatch.setattr(hardneg, name, value)
    assert got(spark, rows, every=20) == brute(rows, 20)


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(i % 3), [float(x) for x in rng.integers(0, 3, size=4)]) for i in range(300)]
    assert got(spark, rows, every=10) == brute(rows, 10)


def test_awkward_rows(spark):
    rows = some(200, 6, 7) + [
        (1000, None, [1.0] * 6), (1050, 1, None), (1100, 2, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1150, 2, [float("nan")] * 6), (1200, 1, [float("inf")] * 6),
        (1250, 1, []), (1300, 2, [1.0, 2.0]), (1350, 3, [1.0] * 9), (1400, 0, [0.0] * 6), (None, 1, [1.0] * 6), (1450, -3, [-1.0] * 6), (1500, 77, [1.0] * 6),
        (50, 0, [2.0] * 6), (50, 0, [2.0] * 6), (100, 3, [-5.0] * 6),
    ]
    assert got(spark, rows) == brute(rows)
    clash = frame(spark, rows).withColumn("low", F.lit(1)).withColumn("block", F.lit("x")).withColumn("score", F.lit(None)).withColumn("vec", F.lit(3))
    assert sorted(tuple(r) for r in hardneg.hard_negatives(clash).collect()) == brute(rows)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, int(i % 2), [float(x) for x in rng.integers(-3, 9, size=3) * 250_000 + rng.integers(0, 9, size=3)]) for i in range(120)]
    rows = [(i, label, [x * 3.0 for x in v]) for i, label, v in rows]
    assert max(abs(r[4]) for r in brute(rows, 10)) > 1 << 53
    assert got(spark, rows, every=10) == brute(rows, 10)


@pytest.mark.parametrize("rows", [[], [(50, 1, [1.0])], [(50, 1, [1.0]), (51, 1, [1.0])], [(50, 1, [1.0]), (51, 2, [1.0])]])
def test_few_rows(spark, rows):
    assert got(spark, rows) == []


def test_index_finds_every_pair_above_a_threshold():
    rng = np.random.default_rng(6)
    q, x = (np.floor(rng.normal(size=(n, 30)) * 50 * np.exp(-np.arange(30) / 6)) for n in (40, 300))
    whole = q @ x.T
    for low in (np.full(40, -1e9), np.full(40, 0.0), np.quantile(whole, 0.99, axis=1), np.full(40, whole.max() + 1)):
        i, j, score = hardneg.Index(x).above(q, hardneg._norms(q), low)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(whole >= low[:, None]))))
        assert (score == whole[i, j]).all()
