"""Box search inside a task, and the nearest rows of a table by own cell first, against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tablelearn.plans import neighbors
from tablelearn.plans.boxes import Boxes, search


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
def test_search_leaves_out_boxes_and_loses_no_row(metric):
    rng = np.random.default_rng(5)
    t = np.column_stack([np.round(rng.uniform(0, 30, 4_000), 1), rng.integers(0, 25, 4_000)])  # many equal distances
    q = np.concatenate([t[:2_000], rng.uniform(-50, 80, (20, 2))])
    ids = rng.permutation(len(t))
    target, seen = Boxes(t), 0

    def exact(rows, at):
        nonlocal seen
        seen += len(rows) * len(at)
        return neighbors.distances(q[rows], target.x[at], metric)

    row, at, d = search(q, np.full(len(q), np.inf), ids[target.order], target, 5, lambda rows: target.gaps(q[rows], metric), exact)
    whole = neighbors.distances(q, t, metric)
    for i in range(len(q)):
        order = np.lexsort((ids, whole[i]))[:5]
        assert ids[target.order][at[row == i]].tolist() == ids[order].tolist()
        assert d[row == i].tolist() == whole[i, order].tolist()
    assert seen < len(q) * len(t) / 4


def test_search_stops_at_the_bound():
    t = np.arange(300.0)[:, None]
    target = Boxes(t)
    exact = lambda rows, at: neighbors.distances(t[rows], target.x[at], "euclidean")
    row, at, d = search(t, np.full(300, 1.0), target.order, target, 5, lambda rows: target.gaps(t[rows], "euclidean"), exact)
    assert d.max() == 1.0 and len(row) == 3 * 298 + 2 * 2


def test_cells_are_visited_within_the_distance_found_at_home(spark):
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.uniform(0, 11, 3_000), rng.integers(0, 5, 3_000)])
    rows = neighbors.points(spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double"), "id", ["a", "b"], "euclidean")
    cells = neighbors.PivotCells(rows, "id", "euclidean", 100)
    asking = rows.withColumnRenamed("id", "q")
    first = neighbors._nearest_at_home(cells, asking, 5)
    away = neighbors._away(cells, first, 5).count()
    assert first.count() == len(x)
    assert away < 3 * len(x) and away < cells.route(asking, k=5).count() / 2


def test_repeated_ids_and_few_rows(spark):
    """Repeated query rows bring their neighbours once each; a cell with fewer than k rows asks the others."""
    train = spark.createDataFrame([(i, [float(v)]) for i, v in enumerate([0, 0, 0, 50, 51, 100, 200, 400])], "id long, x array<double>")
    asking = spark.createDataFrame([(1, [50.0]), (1, [50.0]), (2, [390.0])], "id long, x array<double>")
    got = [(r.query, r.neighbor, r.distance, r["rank"]) for r in neighbors.knn(train, asking, 3, "euclidean", block_rows=2).orderBy("query", "rank").collect()]
    assert got == [(1, 3, 0.0, 1), (1, 3, 0.0, 2), (1, 4, 1.0, 3), (2, 7, 10.0, 1), (2, 6, 190.0, 2), (2, 5, 290.0, 3)]
