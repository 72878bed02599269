"""A tree grown level by level from counts by (node, column, bin, target bucket)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .lineage import checkpointed
from .quantiles import exact_quantiles
from .sums import lists_to_matrix

#: Splits of a level that are sent to all tasks; more are joined by node.
BROADCAST_SPLITS = 100_000
CRITERIA = ("squared_error", "friedman_mse", "absolute_error", "poisson", "gini", "entropy")
_ROOM = 1e-12


def cut_points(data: DataFrame, name: str, most: int) -> list[float]:
    """Where a column may be cut: between any two of its values if there are at most ``most``, else at ``most`` quantiles."""
    few = sorted(r.v for r in data.select(F.col(f"`{name}`").alias("v")).distinct().limit(most + 1).collect())
    if len(few) <= most:
        return [(a + b) / 2 for a, b in zip(few, few[1:])]
    marks = [i / most for i in range(1, most)]
    return sorted(set(exact_quantiles(data, [name], marks)[0][0]))


def _median(values: np.ndarray, weights: np.ndarray) -> float:
    """Of rising values that stand for so many rows; the middle of the two middle rows if their number is even."""
    upto, half = np.cumsum(weights), weights.sum() / 2
    low = values[np.searchsorted(upto, half - 1e-9)]
    high = values[np.searchsorted(upto, half + 1e-9)] if half + 1e-9 < upto[-1] else values[-1]
    return float((low + high) / 2)


def _gap(values: np.ndarray, weights: np.ndarray) -> float:
    return float((weights * np.abs(values - _median(values, weights))).sum()) if weights.sum() else 0.0


def spread(count: np.ndarray, total: np.ndarray, squares: np.ndarray, criterion: str) -> float:
    """Impurity times rows of a node with so many rows, target sum and squares in each target bucket."""
    n, s = count.sum(), total.sum()
    if criterion in ("squared_error", "friedman_mse"):
        return max(0.0, float(squares.sum() - s * s / n))
    if criterion == "absolute_error":
        held = count > 0
        return _gap(total[held] / count[held], count[held])
    if criterion == "poisson":  # up to a part that is the same on both sides of every split
        return float(-s * np.log(s / n)) if s > 0 else 0.0
    share = count[count > 0] / n
    return float(n * (1 - (share * share).sum())) if criterion == "gini" else float(-n * (share * np.log2(share)).sum())


def best_split(count, total, squares, criterion: str, min_leaf: int):
    """(bin, gain) of the best cut of one column in one node: arrays bins x buckets; None if no cut leaves ``min_leaf`` rows
    on both sides. Of equal gains the lowest cut is taken."""
    left = [np.cumsum(a, axis=0)[:-1] for a in (count, total, squares)]
    whole = [a.sum(axis=0) for a in (count, total, squares)]
    before, best = spread(*whole, criterion), None
    for b in range(len(left[0])):
        one = [a[b] for a in left]
        other = [w - a for w, a in zip(whole, one)]
        if one[0].sum() < min_leaf or other[0].sum() < min_leaf:
            continue
        if criterion == "poisson" and (one[1].sum() <= 0 or other[1].sum() <= 0):
            continue
        gain = before - spread(*one, criterion) - spread(*other, criterion)
        if best is None or gain > best[1] + _ROOM * max(1.0, abs(before)):
            best = (b, gain)
    return best


def node_value(count, total, criterion: str):
    """What a leaf predicts: mean, median, or the share of each class."""
    if criterion in ("gini", "entropy"):
        return (count / count.sum()).tolist()
    if criterion == "absolute_error":
        held = count > 0
        return _median(total[held] / count[held], count[held])
    return float(total.sum() / count.sum())


def _binned(data: DataFrame, cols: list[str], target: str, cuts: list[list[float]], marks: list[float] | None) -> DataFrame:
    """(node, bins, bucket, y): the number of cuts below each column's value, and of ``marks`` below the target."""
    arrays, ends = [np.array(c) for c in cuts], None if marks is None else np.array(marks)

    def work(batches):
        for batch in batches:
            x = lists_to_matrix(batch.column(0))
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            bins = np.stack([np.searchsorted(a, x[:, j], side="left") for j, a in enumerate(arrays)], axis=1) if len(x) else np.zeros((0, len(arrays)), int)
            bucket = y.astype(np.int32) if ends is None else np.searchsorted(ends, y, side="left").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(arrays)), pa.array(bins.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(x), np.int64)), lists, pa.array(bucket), pa.array(y)], names=["node", "bins", "bucket", "y"])

    rows = data.select(F.array(*[F.col(f"`{c}`") for c in cols]).alias("x"), F.col(f"`{target}`").cast("double").alias("y"))
    return checkpointed(rows.mapInArrow(work, "node long, bins array<int>, bucket int, y double"))


def grow(data: DataFrame, cols: list[str], target: str, criterion: str, max_depth: int, min_split: int = 2, min_leaf: int = 1,
         max_bins: int = 64, buckets: int = 256, classes: int = 0) -> list[dict]:
    """Nodes of a tree on numeric columns without nulls, the root first: id (children 2 id and 2 id + 1), n, value, impurity
    and, where it is split, feature, threshold (at most: left) and gain.

    A level costs one aggregate over (node, column, bin, bucket), which combines before it shuffles; the best cut of a
    node is found in tasks of one (node, column) each, and one row per open node reaches the driver, which holds the tree.
    A node is split only if it has ``min_split`` rows, is not pure, and each side keeps ``min_leaf``. The median of
    ``absolute_error`` comes from target buckets: exact up to ``buckets`` different targets, else means of quantile buckets.
    With ``classes`` the target is the class number.
    """
    if criterion not in CRITERIA:
        raise ValueError(f"criterion must be one of {CRITERIA}")
    cuts = [cut_points(data, c, max_bins) for c in cols]
    marks = None if classes else cut_points(data, target, buckets) if criterion == "absolute_error" else []
    width = classes or len(marks) + 1
    rows = _binned(data, cols, target, cuts, marks)
    if criterion == "poisson" and rows.where("y < 0").limit(1).count():
        raise ValueError("criterion poisson needs targets that are not negative")
    sizes = [len(c) + 1 for c in cuts]
    nodes, depth = {}, 0

    def search(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        node, j = int(key[0]), int(key[1])
        count, total, squares = (np.zeros((sizes[j], width)) for _ in range(3))
        at = (part["bin"].to_numpy(), part["bucket"].to_numpy())
        count[at], total[at], squares[at] = part["n"], part["s"], part["q"]
        sides = [a.sum(axis=0) for a in (count, total, squares)]
        impurity = spread(*sides, criterion)
        told = {"node": node, "j": j, "n": int(sides[0].sum()), "bin": -1, "gain": -np.inf, "impurity": impurity,
                "value": np.atleast_1d(node_value(sides[0], sides[1], criterion)).tolist(), "pure": bool(squares.sum() - total.sum() ** 2 / count.sum() <= _ROOM * max(1.0, squares.sum())) if not classes else bool((sides[0] > 0).sum() < 2)}
        if told["n"] >= max(min_split, 2 * min_leaf) and not told["pure"] and depth < max_depth:
            found = best_split(count, total, squares, criterion, min_leaf)
            if found is not None:
                told["bin"], told["gain"] = found
        return pd.DataFrame([told])

    schema = "node long, j int, n long, bin int, gain double, impurity double, value array<double>, pure boolean"
    while True:
        each = rows.select("node", "bucket", "y", F.posexplode("bins").alias("j", "bin"))
        cells = each.groupBy("node", "j", "bin", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
        found = cells.groupBy("node", "j").applyInPandas(search, schema)
        # the largest gain; of equal ones the first column
        best = {}
        for r in found.groupBy("node").agg(F.collect_list(F.struct(*[c.split()[0] for c in schema.split(", ") if not c.startswith("node")])).alias("all")).collect():
            ranked = sorted(r["all"], key=lambda a: a.j)
            first = ranked[0]
            for a in ranked[1:]:
                if a.gain > first.gain + _ROOM * max(1.0, abs(first.impurity)) or (first.bin < 0 <= a.bin):
                    first = a
            best[r.node] = first
        splits = []
        for node, a in sorted(best.items()):
            nodes[node] = {"id": node, "n": a.n, "value": list(a.value) if classes else a.value[0], "impurity": a.impurity / a.n}
            if a.bin >= 0:
                nodes[node] |= {"feature": a.j, "threshold": cuts[a.j][a.bin], "gain": a.gain / a.n}
                splits.append((node, a.j, a.bin))
        if not splits:
            return [nodes[i] for i in sorted(nodes)]
        table = rows.sparkSession.createDataFrame(splits, "node long, j int, cut int")
        moved = rows.join(F.broadcast(table) if len(splits) <= BROADCAST_SPLITS else table, "node")
        right = F.when(F.get("bins", F.col("j")) > F.col("cut"), 1).otherwise(0)
        rows = checkpointed(moved.select((F.col("node") * 2 + right).alias("node"), "bins", "bucket", "y"))
        depth += 1


def descend(nodes: list[dict], x: np.ndarray) -> np.ndarray:
    """The place in ``nodes`` of each row's leaf."""
    place = {n["id"]: i for i, n in enumerate(nodes)}
    feature = np.array([n.get("feature", -1) for n in nodes])
    threshold = np.array([n.get("threshold", np.nan) for n in nodes])
    child = np.array([[place.get(2 * n["id"] + s, -1) for s in (0, 1)] for n in nodes])
    at = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return at
        here = at[inner]
        at[inner] = child[here, (x[inner, feature[here]] > threshold[here]).astype(int)]
