import numpy as np
import pytest

from tablelearn.llm import metricjoin, mixing


def brute(rows, threshold):
    good = [(i, np.asarray(v, float)) for i, v in rows
            if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and np.any(np.asarray(v, float))]
    label, links = {}, {}
    for i, v in good:
        near = [j for j, w in good if len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold]
        links[i], label[i] = len(near) - 1, min(near)
    for _ in good:
        for i, v in good:
            for j, w in good:
                if len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                    label[i] = label[j] = min(label[i], label[j])
    return links, label


@pytest.mark.parametrize("cell,block", [(8192, 8192), (12, 7)])
def test_similar_vectors_equal_brute_force(spark, cell, block):
    rng = np.random.default_rng(4)
    rows, centers = [], rng.normal(size=(5, 6))
    for i in range(90):
        v = rng.normal(size=6) if i % 3 else centers[i % 5] + rng.normal(size=6) * 0.12
        rows.append((i, [float(x) for x in v]))
    rows += [(100 + k, rows[0][1]) for k in range(15)]  # copies
    rows += [(200, None), (201, [0.0] * 6), (202, [float("nan")] * 6), (203, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0]),
             (205, []), (206, [1.0, 2.0]), (207, [2.0, 4.0]), (None, rows[0][1]), (208, [x * 1e200 for x in rows[1][1]]), (209, [-0.0] * 6)]
    frame = spark.createDataFrame([(i, v, 1, "n") for i, v in rows], "vec_id long, embedding array<double>, many int, vec string")
    got = {r["vec_id"]: r for r in metricjoin.similar_vectors(frame, cell_rows=cell, block_rows=block).collect()}
    with np.errstate(over="ignore", invalid="ignore"):
        links, label = brute([(i, [x / 1e200 for x in v] if i == 208 else v) for i, v in rows], 0.95)
    assert len(got) == len(rows)
    for i, _ in rows:
        if i is None:
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, None, False)
        else:
            assert got[i]["n_links"] == links.get(i, 0) and got[i]["component_id"] == label.get(i, i) and got[i]["kept"] == (label.get(i, i) == i)


def test_similar_vectors_empty(spark):
    assert metricjoin.similar_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    only = metricjoin.similar_vectors(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in only] == [(1, 0, 1, True)]


def test_similar_vectors_sends_every_row_once(spark):
    """However many cells a vector may have partners in, it is packed once and blocks stay small."""
    x = np.random.default_rng(3).normal(size=(600, 24))
    frame = spark.createDataFrame([(i, 1, v) for i, v in enumerate(x.tolist())], "name long, many long, vec array<double>").repartition(3)
    pivots = metricjoin._unit(x[:20])
    packed, blocks = metricjoin.packed_blocks(frame, pivots, np.sqrt(0.1), 25)
    found = packed.collect()
    names = [np.frombuffer(r["name"], np.int64) for r in found]
    assert len(found) <= blocks and sorted(np.concatenate(names)) == list(range(600))
    assert sum(len(r["reaches"]) for r in found) > 10 * blocks  # before, a row was copied to so many cells
    for r, n in zip(found, names):
        assert np.allclose(np.frombuffer(r["x"], float).reshape(len(n), 24), x[n])
        assert set((metricjoin._unit(x[n]) @ pivots.T).argmax(axis=1)) == {r["cell"]}


def test_similar_vectors_with_equal_pivots(spark):
    """Multiples of a vector are different rows of one direction, so pivots are equal and cells may stay empty."""
    base = np.random.default_rng(5).normal(size=(4, 7))
    rows = [(i, (base[i % 4] * (1 + i // 4)).tolist()) for i in range(48)]
    got = metricjoin.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cell_rows=3, block_rows=4).collect()
    assert sorted(tuple(r) for r in got) == [(i, 11, i % 4, i < 4) for i in range(48)]


@pytest.mark.parametrize("noise", [0.02, 0.2, 1.0])
def test_links_of_two_blocks(noise):
    """Few and very many links, more rows than a tile."""
    rng = np.random.default_rng(8)
    x = metricjoin._unit(np.repeat(rng.normal(size=(40, 9)), 33, axis=0) + noise * rng.normal(size=(1320, 9)))[rng.permutation(1320)]
    names, many = rng.permutation(1320), rng.integers(1, 4, 1320)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    cut = [np.arange(700), np.arange(700, 1320)]
    states = [metricjoin.Links({"x": x[c], "name": names[c], "many": many[c]}, 0.95) for c in cut]
    told = [states[0].add({"x": x[cut[1]], "name": names[cut[1]], "many": many[cut[1]]}, np.arange(700), np.arange(620))]
    for state in states:
        state.within()
        told.append(state.rows())
    links, parent = dict.fromkeys(names.tolist(), 0), {n: n for n in names.tolist()}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for part in told:
        for n, k, r in zip(*(c.to_pylist() for c in part.columns)):
            links[n] += k
            parent[max(top(n), top(r))] = min(top(n), top(r))
    reached = near | np.eye(1320, dtype=bool)
    while not np.array_equal(more := (reached.astype(np.float32) @ reached > 0), reached):
        reached = more
    for i, n in enumerate(names.tolist()):
        assert links[n] == near[i] @ many and top(n) == names[reached[i]].min()


def water(sizes, weights, most):
    """Share again and again what the full ones cannot take."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[n] for n in full)
        open_ = [n for n in names if n not in full]
        share = {n: rest * weight[n] / sum(weight[m] for m in open_) for n in open_}
        over = {n for n in open_ if share[n] >= most * sizes[n]}
        if not over or not open_:
            return {n: share.get(n, most * sizes[n]) for n in names}
        full |= over


def test_mix(spark):
    rng = np.random.default_rng(5)
    rows, number = [], 0
    for source, many in (("b", 400), ("a", 40), ("Z", 25), ("é", 3), (None, 60), ("", 30)):
        for _ in range(many):
            rows.append((number, "w " * int(rng.integers(1, 60)), source))
            number += 1
    rows += [(number, None, "a"), (number + 1, "", "a"), (None, "x y z", "b"), (5, "w w w", "b"), (5, "w w w", "b"), (number + 2, None, "none")]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, source string, size string, target int")
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7), bucket_rows=20).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = water({s: n for s, n in sizes.items()}, (1, 2, 3), 3)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    for source, target in want.items():
        taken = sum(r["taken"] for r in got if r["source"] == source)
        assert abs(taken - target) <= 60  # the largest document
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in got)
    assert sum(len((r["text"] or "").split()) for r in mixed.collect()) == sum(r["taken"] for r in got)


def test_mix_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0 and mixing.mix_documents(docs).count() == 0
    silent = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(silent).collect()] == [0, 0]
