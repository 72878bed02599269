"""Sums over balls: cells with sums and counts enter whole, only cells on the border compare their points."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .lineage import checkpointed
from .sums import lists_to_matrix, sum_vectors

#: Numbers (points x columns) up to which all points go to every task; more are read anew in each round.
INLINE_VALUES = 2_000_000
#: Sides of the cells of each level in bandwidths.
SIDES = (1.0, 0.25, 0.0625)
#: Points of a packed row.
PACK_POINTS = 2_048
#: Centres whose cells are looked at together.
CENTERS = 128


class Cells:
    """Weighted points in a pyramid of cells: each cell has the box of its points, their weight and weighted sum."""

    def __init__(self, x: np.ndarray, w: np.ndarray, bandwidth: float):
        self.bandwidth = bandwidth
        codes = [np.floor(x / (bandwidth * s)) for s in SIDES]
        keys = np.concatenate(codes, axis=1) if len(x) else np.zeros((0, len(SIDES) * x.shape[1]))
        order = np.lexsort(keys.T[::-1]) if keys.shape[1] else np.arange(len(x))
        self.x, self.w = x[order], w[order].astype(float)
        keys, self.levels, d = keys[order], [], x.shape[1]
        for k in range(1, len(SIDES) + 1):
            part = keys[:, : k * d]
            new = np.concatenate(([True], (part[1:] != part[:-1]).any(axis=1))) if len(x) else np.zeros(0, bool)
            start = np.flatnonzero(new)
            stop = np.append(start[1:], len(x))
            if len(start):
                lo, hi = np.minimum.reduceat(self.x, start), np.maximum.reduceat(self.x, start)
                n, s = np.add.reduceat(self.w, start), np.add.reduceat(self.x * self.w[:, None], start)
            else:
                lo = hi = s = np.zeros((0, d))
                n = np.zeros(0)
            self.levels.append((start, stop, lo, hi, n, s))

    def sums(self, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weighted sum, weight) of the points within the bandwidth of each centre."""
        total, weight = np.zeros(centers.shape), np.zeros(len(centers))
        for begin in range(0, len(centers), CENTERS):
            some = slice(begin, begin + CENTERS)
            self._add(centers[some], total[some], weight[some])
        return total, weight

    def _add(self, centers, total, weight):
        c, k = np.divmod(np.arange(len(centers) * len(self.levels[0][0])), max(1, len(self.levels[0][0])))
        for depth, (start, stop, lo, hi, n, s) in enumerate(self.levels):
            near = centers[c]
            gap = np.maximum(np.maximum(lo[k] - near, near - hi[k]), 0.0)
            far = np.maximum(near - lo[k], hi[k] - near)
            reach, most = np.sqrt((gap * gap).sum(axis=1)), np.sqrt((far * far).sum(axis=1))
            # cells whose corners lie at the border up to rounding are left to their points
            inside = most <= self.bandwidth * (1 - 1e-12)
            np.add.at(total, c[inside], s[k[inside]])
            np.add.at(weight, c[inside], n[k[inside]])
            border = ~inside & (reach <= self.bandwidth * (1 + 1e-12))
            c, k = c[border], k[border]
            if depth + 1 < len(self.levels):
                below = self.levels[depth + 1][0]
                first, last = np.searchsorted(below, start[k]), np.searchsorted(below, stop[k])
                c, k = np.repeat(c, last - first), _runs(first, last)
            else:
                at = _runs(start[k], stop[k])
                c = np.repeat(c, stop[k] - start[k])
                gap = self.x[at] - centers[c]
                hit = np.sqrt((gap * gap).sum(axis=1)) <= self.bandwidth
                np.add.at(total, c[hit], self.x[at[hit]] * self.w[at[hit], None])
                np.add.at(weight, c[hit], self.w[at[hit]])


def _runs(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first..last-1 of each pair, one after the other."""
    length = last - first
    return np.arange(length.sum()) + np.repeat(first - (np.cumsum(length) - length), length)


def ascend(cells: Cells, at: np.ndarray, max_iter: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, weight around the place before) of each centre moved to the mean around it until it stands still; centres
    without points around them are left out."""
    at, weight, live = at.copy(), np.ones(len(at)), np.ones(len(at), bool)
    for _ in range(max_iter):
        open_ = np.flatnonzero(live)
        if not len(open_):
            break
        total, count = cells.sums(at[open_])
        weight[open_], live[open_] = 0.0, False
        met = count > 0
        open_, moved = open_[met], total[met] / count[met, None]
        gap = np.sqrt(((moved - at[open_]) ** 2).sum(axis=1))
        at[open_], weight[open_], live[open_] = moved, count[met], gap > 1e-3 * cells.bandwidth
    return at[weight > 0], weight[weight > 0]


def modes_inline(points: DataFrame, values: int, seeds: DataFrame, bandwidth: float, max_iter: int) -> DataFrame:
    """(n, x): where the seeds (x) end, in one job: every task has all points (``values`` numbers, checked by the caller)
    and takes its seeds to the top."""
    if values > INLINE_VALUES:
        raise ValueError("too many points to send to every task")
    held = points.select("x", "w").toArrow()
    spark = points.sparkSession
    x, w = lists_to_matrix(held.column("x").combine_chunks()), held.column("w").to_numpy().astype(float)
    sent = spark.sparkContext.broadcast((x, w))
    cores = spark.sparkContext.defaultParallelism

    def work(parts):
        cells = None
        for part in parts:
            if len(part):
                cells = cells or Cells(*sent.value, bandwidth)
                place, weight = ascend(cells, np.stack(part["x"].to_numpy()).astype(float), max_iter)
                yield pd.DataFrame({"n": weight, "x": list(place)})

    return seeds.select("x").repartition(cores).mapInPandas(work, "n double, x array<double>").distinct()


def packed(points: DataFrame, bandwidth: float) -> DataFrame:
    """(x, w): points (x, w) as rows of up to PACK_POINTS neighbours, flattened. Cells of four bandwidths are cut by hash, so
    a full cell becomes many rows."""
    cell = F.transform("x", lambda v: F.floor(v / F.lit(4 * bandwidth)))
    cells = points.withColumn("cell", cell)
    sizes = checkpointed(cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PACK_POINTS).alias("slices")))
    dealt = cells.join(sizes, "cell").withColumn("slice", F.pmod(F.xxhash64("x"), F.col("slices")))
    rows = dealt.groupBy("cell", "slice").agg(F.collect_list(F.struct("x", "w")).alias("p"))
    return checkpointed(rows.select(F.flatten(F.col("p.x")).alias("x"), F.transform("p.w", lambda v: v.cast("double")).alias("w")))


def packed_sums(packs: DataFrame, centers: np.ndarray, bandwidth: float) -> tuple[np.ndarray, np.ndarray]:
    """As :meth:`Cells.sums` over all packed points, in one narrow pass."""
    s, d = centers.shape

    def part(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(s * d + s)
        for xs, ws in zip(batch.column(0), batch.column(1)):
            w = ws.values.to_numpy(zero_copy_only=False)
            total, weight = Cells(xs.values.to_numpy(zero_copy_only=False).reshape(len(w), d), w, bandwidth).sums(centers)
            out += np.concatenate([total.ravel(), weight])
        return out

    sums = sum_vectors(packs, part, s * d + s)
    return sums[: s * d].reshape(s, d), sums[s * d:]
