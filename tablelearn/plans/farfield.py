"""Sums of distances from every row to the rows of each cluster, in one or two columns, without meeting all pairs.

Rows go to the leaves of a k-d tree. What stands for a box of rows from afar are weights at Chebyshev points of the box (its
moments): where the gap is at least ``APART`` times a box's half side, the distance to its rows is so close to a polynomial that the
sums differ from added-up distances by a relative 4e-13 at most as measured, not far from what another order of adding gives.
Nearer leaves meet row by row. The work grows with the rows times the depth of the tree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import ClusterSums
from .lineage import checkpointed
from .sums import lists_to_matrix

#: Columns that boxes may have, rows of a leaf, and rows of the sample that the cuts are taken from, for each leaf.
COLUMNS = 2
LEAF_ROWS = 1_024
LEAF_SAMPLE = 12
#: Chebyshev points of a side, and the least gap between two boxes in half sides.
POINTS = 14
APART = 2.0
#: Numbers of all moments, which go to every task, and leaves; these become larger beyond.
TREE_NUMBERS = 1 << 23
MAX_LEAVES = 16_384
#: Targets of one task, and leaves that meet a target at once.
TASK_LEAVES = 32
MET_LEAVES = 16
#: How a node is met: box by box, row by box, row by row.
BOX, ROW, NEAR = 0, 1, 2

_ANGLES = (np.arange(POINTS) + 0.5) * np.pi / POINTS
_NODES = np.cos(_ANGLES)
_BASIS = np.cos(np.outer(np.arange(POINTS), _ANGLES))
_BASIS[0] /= 2


def leaves_for(rows: int, clusters: int, columns: int) -> int:
    """Leaves that the moments of ``clusters`` allow."""
    return min(math.ceil(rows / LEAF_ROWS), MAX_LEAVES, TREE_NUMBERS // (2 * clusters * POINTS**columns))


def shares(x: np.ndarray, sides: np.ndarray) -> list[np.ndarray]:
    """For every column the part of each row (from the lower corner) that each Chebyshev point of the box takes; one point where
    the side is empty."""
    out = []
    for j, side in enumerate(sides):
        if side > 0:
            t = np.clip(2.0 * (x[:, j] / side) - 1.0, -1.0, 1.0)
            out.append(np.cos(np.arccos(t)[:, None] * np.arange(POINTS)) @ _BASIS * (2.0 / POINTS))
        else:
            out.append(np.ones((len(x), 1)))
    return out


def points(sides: np.ndarray) -> list[np.ndarray]:
    """Chebyshev points of every column, from the lower corner."""
    return [(side * 0.5) * (_NODES + 1.0) if side > 0 else np.zeros(1) for side in sides]


def _outer(parts: list[np.ndarray]) -> np.ndarray:
    out = parts[0]
    for p in parts[1:]:
        out = (out[:, :, None] * p[:, None, :]).reshape(len(out), -1)
    return out


def moments(x: np.ndarray, weights: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """(points, clusters) that stand for rows (from the lower corner) of ``weights`` (rows, clusters) from afar."""
    return _outer(shares(x, sides)).T @ weights


class Tree:
    """Cuts of a k-d tree over sampled rows; the places of its leaves are their numbers."""

    def __init__(self, sample: np.ndarray, rows: float):
        self.dim, self.cut, self.left, self.right = [], [], [], []
        self._grow(sample, max(1.0, 1.5 * rows))
        self.dim, self.left, self.right = (np.array(c, np.int64) for c in (self.dim, self.left, self.right))
        self.cut = np.array(self.cut, float)
        self.leaf = np.flatnonzero(self.left == np.arange(len(self.left)))

    def _grow(self, x: np.ndarray, rows: float) -> int:
        at = len(self.dim)
        for column, value in ((self.dim, 0), (self.cut, np.inf), (self.left, at), (self.right, at)):
            column.append(value)
        side = np.ptp(x, axis=0)
        j = int(side.argmax())
        if len(x) <= rows or not side[j] > 0:
            return at
        v = np.sort(x[:, j])
        steps = np.flatnonzero(v[1:] > v[:-1])
        cut = v[steps[np.abs(steps + 1 - len(v) / 2).argmin()]]
        below = x[:, j] <= cut
        self.dim[at], self.cut[at] = j, cut
        self.left[at] = self._grow(x[below], rows)
        self.right[at] = self._grow(x[~below], rows)
        return at

    def find(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            below = x[np.arange(len(x)), self.dim[at]] <= self.cut[at]
            deeper = np.where(below, self.left[at], self.right[at])
            if np.array_equal(deeper, at):
                return at
            at = deeper

    def fill(self, low: dict, high: dict, weights: dict) -> None:
        """Boxes and moments of all nodes from those of the leaves; a child comes after its parent."""
        n, d = len(self.left), len(next(iter(low.values())))
        self.low, self.high, self.weights = np.full((n, d), np.inf), np.full((n, d), -np.inf), [None] * n
        for at in range(n - 1, -1, -1):
            if self.left[at] == at:
                if at in low:
                    self.low[at], self.high[at], self.weights[at] = low[at], high[at], weights[at]
                continue
            both = [c for c in (self.left[at], self.right[at]) if self.weights[c] is not None]
            if not both:
                continue
            self.low[at], self.high[at] = self.low[both].min(axis=0), self.high[both].max(axis=0)
            total = 0.0
            for c in both:
                own = [self.low[c][j] - self.low[at][j] + p for j, p in enumerate(points(self.high[c] - self.low[c]))]
                grid = np.stack([g.ravel() for g in np.meshgrid(*own, indexing="ij")], axis=1)
                total = total + moments(grid, self.weights[c], self.high[at] - self.low[at])
            self.weights[at] = total

    def seen_from(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(target, node, way): the nodes that together are all leaves, as seen from each target leaf, and how they are met."""
        half = (self.high - self.low).max(axis=1) / 2
        told, t, s = [], targets, np.zeros(len(targets), np.int64)
        while len(t):
            gap = np.maximum(0.0, np.maximum(self.low[t] - self.high[s], self.low[s] - self.high[t]))
            gap = np.sqrt((gap * gap).sum(axis=1))
            way = np.where((gap > 0) & (gap >= APART * half[s]), np.where(gap >= APART * half[t], BOX, ROW), NEAR)
            end = (way != NEAR) | (self.left[s] == s)
            told.append((t[end], s[end], way[end]))
            t, s = t[~end], s[~end]
            t, s = np.concatenate([t, t]), np.concatenate([self.left[s], self.right[s]])
        return tuple(np.concatenate(c) for c in zip(*told))

    def far_sums(self, x: np.ndarray, at: int, nodes: np.ndarray, ways: np.ndarray) -> np.ndarray:
        """(rows, clusters): sums of the distances from the rows ``x`` of leaf ``at`` to all rows of far ``nodes``."""
        low, sides = self.low[at], self.high[at] - self.low[at]
        own, total, out = points(sides), 0.0, 0.0
        for s in nodes[ways == BOX]:
            square = 0.0
            for j, (a, b) in enumerate(zip(own, points(self.high[s] - self.low[s]))):
                gap = (low[j] - self.low[s][j]) + (a[:, None] - b[None, :])
                shape = [1] * (2 * len(own))
                shape[j], shape[len(own) + j] = gap.shape
                square = square + (gap * gap).reshape(shape)
            total = total + np.sqrt(square).reshape(-1, len(self.weights[s])) @ self.weights[s]
        for s in nodes[ways == ROW]:
            square = 0.0
            for j, b in enumerate(points(self.high[s] - self.low[s])):
                gap = (x[:, j] - self.low[s][j])[:, None] - b[None, :]
                shape = [len(x)] + [1] * len(own)
                shape[1 + j] = len(b)
                square = square + (gap * gap).reshape(shape)
            out = out + np.sqrt(square).reshape(len(x), -1) @ self.weights[s]
        return out + _outer(shares(x - low, sides)) @ total if (ways == BOX).any() else out


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())


def _short(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int32 if len(values) and values.max() < 2**31 else np.int64)


def _whole(column, at: int, size: int) -> np.ndarray:
    raw = column[at].as_buffer()
    return np.frombuffer(raw, np.int32 if raw.size == 4 * size else np.int64)


def cluster_sums(unique: DataFrame, rows: int, clusters: int, leaves: int, told, schema: str) -> DataFrame | None:
    """``told(rows' clusters, rows' ids, sums (rows, clusters))`` for the rows (x, c code, w copies, ids, key) of every leaf; None
    where coordinates are too large for their squares."""
    step = max(1, rows // (LEAF_SAMPLE * leaves))
    sample = lists_to_matrix(unique.where(F.pmod("key", F.lit(step)) == 0).select("x").toArrow().column("x").combine_chunks())  # about LEAF_SAMPLE a leaf
    if not len(sample) or not (np.abs(sample) < 1e150).all():
        return None
    tree = Tree(sample, LEAF_SAMPLE)

    def place(batches):
        for batch in batches:
            at = tree.find(lists_to_matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], names=[*batch.schema.names, "leaf"])

    def pack(group, part):
        x, (c, w, ids) = lists_to_matrix(part.column("x").combine_chunks()), (part.column(n).to_numpy() for n in ("c", "w", "ids"))
        low, high = x.min(axis=0), x.max(axis=0)
        weights = np.zeros((math.prod(POINTS if v > 0 else 1 for v in high - low), clusters))
        for code in np.unique(c):
            weights[:, code] = moments(x[c == code] - low, w[c == code].astype(float), high - low)
        return pa.table([
            pa.array([group[0].as_py()], pa.int32()), pa.array([len(x)], pa.int32()), _bytes(x), _bytes(_short(c)), _bytes(_short(w)), _bytes(_short(ids)),
            pa.array([low], pa.list_(pa.float64())), pa.array([high], pa.list_(pa.float64())), _bytes(weights)],
            names=["leaf", "n", "x", "c", "w", "ids", "low", "high", "weights"])

    placed = unique.select("x", "c", "w", "ids").mapInArrow(place, "x array<double>, c long, w long, ids long, leaf int")
    packed = checkpointed(placed.groupBy("leaf").applyInArrow(
        pack, "leaf int, n int, x binary, c binary, w binary, ids binary, low array<double>, high array<double>, weights binary"))
    low, high, weights = {}, {}, {}
    for r in packed.select("leaf", "low", "high", "weights").toLocalIterator():  # TREE_NUMBERS in all
        low[r.leaf], high[r.leaf] = np.array(r.low), np.array(r.high)
        weights[r.leaf] = np.frombuffer(r.weights).reshape(-1, clusters)
    if not all((np.abs(v) < 1e150).all() for v in (*low.values(), *high.values())):
        return None
    tree.fill(low, high, weights)
    target, source, way = tree.seen_from(np.array(sorted(low)))
    near = way == NEAR
    spark = unique.sparkSession
    pairs = pa.table([pa.array(v[near].astype(np.int32)) for v in (target, source)], names=["target", "leaf"])
    shared = spark.sparkContext.broadcast(tree)

    def total(group, part):
        tree, at = shared.value, group[0].as_py()
        sources, size = part.column("leaf").to_numpy(), part.column("n").to_numpy()
        read = lambda name, i: _whole(part.column(name), i, size[i]).astype(np.int64)
        rows = lambda i: np.frombuffer(part.column("x")[i].as_buffer()).reshape(size[i], -1)
        own = int(np.flatnonzero(sources == at)[0])
        held = ClusterSums({"x": rows(own)}, clusters)
        for start in range(0, len(sources), MET_LEAVES):
            some = range(start, min(start + MET_LEAVES, len(sources)))
            held.add({"x": np.concatenate([rows(i) for i in some]), "c": np.concatenate([read("c", i) for i in some]), "w": np.concatenate([read("w", i) for i in some])})
        _, nodes, ways = tree.seen_from(np.array([at]))
        held.sums += tree.far_sums(rows(own), at, nodes, ways)
        return told(read("c", own), read("ids", own), held.sums)

    met = packed.join(F.broadcast(spark.createDataFrame(pairs)), "leaf").select(
        "target", "leaf", "n", "x", "c", "w", F.when(F.col("leaf") == F.col("target"), F.col("ids")).alias("ids"))
    return met.repartition(max(1, math.ceil(len(low) / TASK_LEAVES)), "target").groupBy("target").applyInArrow(total, schema)
