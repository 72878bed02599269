"""Agglomerative merging of any number of rows: rounds of reciprocal nearest neighbours over a table of clusters."""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .boxes import Boxes, search
from .components import components
from .lineage import checkpointed
from .neighbors import PivotCells, _ints, _matrix, distances, nearest_block_rows, pieces
from .sums import lists_to_matrix

#: Clusters that one task merges to the end; more go through another round.
FINISH_CLUSTERS = 2_048
KINDS = ("ward", "average_squared")
#: Most columns of clusters that are merged inside their cells first, and pivots whose borders are looked at one by one.
LOCAL_COLUMNS = 3
BORDER_PIVOTS = 32
#: Cells above so many blocks leave their clusters to the rounds over all cells; so do passes that merge less than a quarter.
LOCAL_BLOCKS = 4
#: Steps of one round.
ROUND_STEPS = 1 << 32
_FIELDS = "key long, x array<double>, n double, s double"


def height(kind: str, gap2, n, s, m, t):
    """Merging height of clusters with squared distance ``gap2`` of the centres, sizes n and m, and mean squared distance of
    the members to the centre s and t. Both kinds are reducible: two clusters' nearest distances never fall by a merge
    of others, so reciprocal nearest neighbours can merge in any order."""
    return 2 * n * m / (n + m) * gap2 if kind == "ward" else gap2 + s + t


def joined(x, n, s, y, m, t):
    """Centre, size and spread of two clusters together."""
    size = n + m
    gap2 = ((x - y) ** 2).sum(axis=-1)
    return (x * n[..., None] + y * m[..., None]) / size[..., None], size, (n * s + m * t) / size + n * m / (size * size) * gap2


class _Clusters(PivotCells):
    """Clusters in pivot cells, with the ranges of size and spread that each cell holds."""

    def __init__(self, rows: DataFrame, kind: str, block_rows: int):
        super().__init__(rows, "key", "euclidean", block_rows)
        self.kind, p = kind, len(self.pivots)
        self.sizes, self.spreads = np.ones((2, p)), np.zeros((2, p))
        for r in self.rows.groupBy("cell").agg(*[f(c).alias(f"{c}{i}") for c in ("n", "s") for i, f in enumerate((F.min, F.max))]).collect():
            self.sizes[:, r.cell], self.spreads[:, r.cell] = (r.n0, r.n1), (r.s0, r.s1)

    def route_nearest(self, first: DataFrame) -> DataFrame:
        """Each cluster (``first``: with the least height ``h`` found in its own cell ``home``) once for every other cell that can
        hold its nearest one: that height and the cells' largest possible heights bound the least height, their smallest
        possible heights decide."""
        pivots, count, lo, hi, kind, sizes, spreads = self.pivots, self.count, self.lo, self.hi, self.kind, self.sizes, self.spreads

        def send(batches):
            for batch in pieces(batches):
                d = distances(lists_to_matrix(batch.column(1)), pivots, "euclidean")
                n, s = (batch.column(i).to_numpy()[:, None] for i in (2, 3))
                reach = d + np.where(count > 0, hi, np.inf)
                with np.errstate(invalid="ignore"):
                    most = np.where(count > 0, height(kind, reach * reach, n, s, sizes[1], spreads[1]), np.inf)
                order = np.argsort(most, axis=1)
                enough = np.cumsum(count[order], axis=1) >= min(2, count.sum())  # one of them may be the cluster itself
                bound = np.take_along_axis(most, order, axis=1)[np.arange(len(d)), enough.argmax(axis=1)]
                bound = np.fmin(bound, batch.column("h").to_numpy())
                near = np.maximum(np.maximum(d - hi, lo - d), 0.0)
                least = height(kind, near * near * (1 - 1e-9), n, s, sizes[0], spreads[0])
                reached = (least <= bound[:, None] * (1 + 1e-9)) & (count > 0)
                reached[np.arange(len(d)), batch.column("home").to_numpy()] = False
                row, cell = np.nonzero(reached)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in batch.columns), pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "cell"])

        return first.select("key", "x", "n", "s", "home", "h").mapInArrow(send, f"{_FIELDS}, home int, h double, cell int")

    def nearest(self) -> DataFrame:
        """(key, h, other): the nearest cluster of each, the smallest key of equal ones."""
        kind = self.kind

        def found_in(q: pa.Table, t: pa.Table, bound: np.ndarray):
            """(row of q, height, key of t) for the rows of q that have one within their bounds."""
            x, n, s, ours = _matrix(q), _ints(q, "n"), _ints(q, "s"), _ints(q, "key")
            target = Boxes(_matrix(t))
            keys, m, spread = (_ints(t, c)[target.order] for c in ("key", "n", "s"))
            few, tight = np.minimum.reduceat(m, target.starts), np.minimum.reduceat(spread, target.starts)

            def least(rows):
                gap = target.gaps(x[rows], "euclidean")
                return height(kind, gap * gap, n[rows, None], s[rows, None], few, tight) * (1 - 1e-9)

            def exact(rows, at):
                gap = distances(x[rows], target.x[at], "euclidean")
                h = height(kind, gap * gap, n[rows, None], s[rows, None], m[at], spread[at])
                h[ours[rows, None] == keys[at]] = np.inf
                return h

            row, at, h = search(x, bound, keys, target, 1, least, exact)
            real = np.isfinite(h)
            return row[real], h[real], keys[at[real]]

        def best(q: pa.Table, t: pa.Table) -> pa.Table:
            h, other = np.full(q.num_rows, np.inf), _ints(q, "key").copy()
            if q.num_rows and t.num_rows:
                row, least, key = found_in(q, t, h)
                h[row], other[row] = least, key
            return pa.table({**{c: q.column(c) for c in ("key", "x", "n", "s")}, "home": q.column("cell"), "h": h, "other": other})

        def better(q: pa.Table, t: pa.Table) -> pa.Table:
            schema = pa.schema([("key", pa.int64()), ("h", pa.float64()), ("other", pa.int64())])
            if not q.num_rows or not t.num_rows:
                return schema.empty_table()
            row, h, other = found_in(q, t, _ints(q, "h"))
            return pa.table([_ints(q, "key")[row], h, other], schema=schema)

        first = self.block_join(self.rows.drop("r"), "key", best, f"{_FIELDS}, home int, h double, other long")
        if self.count.max() > self.block_rows:
            same = [F.first(c).alias(c) for c in ("x", "n", "s", "home")]  # in every slice of the cell
            first = first.groupBy("key").agg(*same, F.min(F.struct("h", "other")).alias("b")).select("key", "x", "n", "s", "home", "b.h", "b.other")
        first = checkpointed(first)
        found = first.where(F.col("h") < F.lit(float("inf"))).select("key", "h", "other")
        if len(self.pivots) > 1:
            found = found.unionByName(self.block_join(self.route_nearest(first), "key", better, "key long, h double, other long"))
        return found.groupBy("key").agg(F.min(F.struct("h", "other")).alias("b")).select("key", "b.h", "b.other")


def _borders(pivots: np.ndarray, cell: int):
    """A function that gives a lower bound of the distance from points of a cell to all points of other cells."""
    here = pivots[cell]
    away = distances(here[None, :], pivots, "euclidean")[0]
    order = np.argsort(away, kind="stable")
    order = order[order != cell]
    near, rest = pivots[order[:BORDER_PIVOTS]], away[order[BORDER_PIVOTS:]]

    def border(x):
        own = distances(x, here[None, :], "euclidean")
        out = np.full(len(x), np.inf)
        if len(near):  # the planes half way to the nearest pivots
            d = distances(x, near, "euclidean")
            out = (((d - own) * (d + own) / (2 * away[order[:BORDER_PIVOTS]])) - 1e-9 * (d + own)).min(axis=1)
        if len(rest):  # all others are at least as far away as the next one
            out = np.minimum(out, rest[0] / 2 - own[:, 0] * (1 + 1e-9))
        return np.maximum(out * (1 - 1e-9), 0.0)

    return border


def merge_inside(x: np.ndarray, n: np.ndarray, s: np.ndarray, keys: np.ndarray, kind: str, border):
    """((centres, sizes, spreads, keys) of the clusters left, [(a, b, h, round)]): the clusters of one cell merged for as long as
    reciprocal nearest ones are nearer than anything outside the cell can be. Heights never fall by merges of others, so these
    are reciprocal nearest ones among all clusters, whatever the other cells do."""
    order = np.argsort(keys)
    x, n, s, keys, found, turn = x[order], n[order], s[order], keys[order], [], 0
    while len(keys) > 1:
        target = Boxes(x)
        few, tight = np.minimum.reduceat(n[target.order], target.starts), np.minimum.reduceat(s[target.order], target.starts)

        def least(rows):
            gap = target.gaps(x[rows], "euclidean")
            return height(kind, gap * gap, n[rows, None], s[rows, None], few, tight) * (1 - 1e-9)

        def exact(rows, at):
            there = target.order[at]
            gap = distances(x[rows], x[there], "euclidean")
            h = height(kind, gap * gap, n[rows, None], s[rows, None], n[there], s[there])
            h[rows[:, None] == there] = np.inf
            return h

        edge = border(x)
        outside = height(kind, edge * edge, n, s, 1.0, 0.0)
        row, at, h = search(x, outside, keys[target.order], target, 1, least, exact)
        near, low = np.arange(len(x)), np.full(len(x), np.inf)
        near[row], low[row] = target.order[at], h
        a = np.flatnonzero((near[near] == np.arange(len(x))) & (near > np.arange(len(x))) & (low < outside) & (low[near] < outside[near]))
        if not len(a):
            break
        b = near[a]
        found.append((keys[a], keys[b], low[a], np.full(len(a), turn)))
        x[a], n[a], s[a] = joined(x[a], n[a], s[a], x[b], n[b], s[b])
        keep = np.ones(len(x), bool)
        keep[b] = False
        x, n, s, keys, turn = x[keep], n[keep], s[keep], keys[keep], turn + 1
        if len(a) < len(keys) // 100:
            break
    return (x, n, s, keys), found


def merged_inside(clusters: DataFrame, kind: str, block_rows: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """(clusters left, merges) after :func:`merge_inside` in every cell; full cells stay as they are."""
    cells = PivotCells(clusters, "key", "euclidean", block_rows)
    pivots, full = cells.pivots, set(np.flatnonzero(cells.count > LOCAL_BLOCKS * block_rows).tolist())

    def work(group, part):
        cell = group[0].as_py()
        left, found = (_matrix(part).copy(), *(_ints(part, c).copy() for c in ("n", "s", "key"))), []
        if cell not in full:
            left, found = merge_inside(*left, kind, _borders(pivots, cell))
        x, n, s, keys = left
        m = sum(len(f[0]) for f in found)
        pad = lambda v, t: pa.concat_arrays([pa.nulls(len(keys), t), pa.array(np.concatenate([f[v] for f in found]), t)]) if m else pa.nulls(len(keys), t)
        lists = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
        return pa.table({
            "key": pa.concat_arrays([pa.array(keys), pa.nulls(m, pa.int64())]), "x": pa.concat_arrays([lists, pa.nulls(m, lists.type)]),
            "n": pa.concat_arrays([pa.array(n), pa.nulls(m, pa.float64())]), "s": pa.concat_arrays([pa.array(s), pa.nulls(m, pa.float64())]),
            "a": pad(0, pa.int64()), "b": pad(1, pa.int64()), "h": pad(2, pa.float64()), "step": pad(3, pa.int64()),
        })

    tasks = min(len(pivots), 4 * clusters.sparkSession.sparkContext.defaultParallelism)  # few bytes, much work
    both = checkpointed(cells.rows.drop("r").repartition(tasks, "cell").groupBy("cell").applyInArrow(work, f"{_FIELDS}, a long, b long, h double, step long"))
    found = both.where("a is not null").select("a", "b", "h", (F.col("step") + turn * ROUND_STEPS).alias("step"))
    return both.where("key is not null").select("key", "x", "n", "s"), found


def chain_merges(x: np.ndarray, n: np.ndarray, s: np.ndarray, keys: np.ndarray, kind: str) -> list[tuple[int, int, float]]:
    """All merges (a, b, height) of a bounded set of clusters by a chain of nearest neighbours; a cluster keeps the smaller
    key. Memory is a few vectors, not a matrix."""
    x, n, s, keys, alive = x.copy(), n.astype(float).copy(), s.astype(float).copy(), keys.copy(), np.ones(len(x), bool)
    chain, out = [], []
    while alive.sum() > 1:
        if not chain:
            live = np.flatnonzero(alive)
            chain = [live[keys[live].argmin()]]
        tip = chain[-1]
        others = np.flatnonzero(alive)
        others = others[others != tip]
        h = height(kind, ((x[others] - x[tip]) ** 2).sum(axis=1), n[tip], s[tip], n[others], s[others])
        best = h.min()
        if len(chain) > 1 and h[others == chain[-2]][0] <= best:  # the one before wins ties, so the chain ends
            other = chain[-2]
        else:
            tied = others[h <= best]
            other = tied[keys[tied].argmin()]
        if len(chain) > 1 and other == chain[-2]:
            a, b = sorted((tip, other), key=lambda i: keys[i])
            out.append((int(keys[a]), int(keys[b]), float(best)))
            x[a], n[a], s[a] = joined(x[a], n[a], s[a], x[b], n[b], s[b])
            alive[b] = False
            chain = chain[:-2]
        else:
            chain.append(other)
    return out


def merges(points: DataFrame, kind: str, finish: int = FINISH_CLUSTERS, block_rows: int | None = None) -> DataFrame:
    """``points`` (key, x, w: copies) -> (a, b, h, step): the merges that lead to one cluster, named by their smallest keys;
    ``step`` rises from a merge to those that build on it.

    A cluster is its centre, size and spread. In few columns the clusters of a cell first merge among themselves as far as
    the cell's borders allow, then among those of other cells. Where that does not merge many, every cluster looks for its
    nearest one in the cells that can hold it, and all reciprocal pairs merge; at least the closest pair does. Once ``finish`` clusters are left, one task
    merges them, whatever the number of rows was.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    clusters = checkpointed(points.select("key", "x", F.col("w").cast("double").alias("n"), F.lit(0.0).alias("s")))
    block_rows = block_rows or nearest_block_rows(clusters)
    left, done, turn = clusters.count(), [], 0
    first = clusters.select("x").first()
    local = first is not None and len(first.x) <= LOCAL_COLUMNS
    while left > finish:
        if local:
            clusters, found = merged_inside(clusters, kind, block_rows, turn)
            done.append(found)
            before, left, turn = left, clusters.count(), turn + 1
            if left <= finish or left <= 0.75 * before:
                continue
        near = checkpointed(_Clusters(clusters, kind, block_rows).nearest())
        back = near.select(F.col("key").alias("other"), F.col("other").alias("key"))
        pairs = checkpointed(near.join(back, ["key", "other"]).where("key < other").select(F.col("key").alias("a"), F.col("other").alias("b"), "h"))
        done.append(pairs.withColumn("step", F.lit(turn * ROUND_STEPS).cast("long")))
        gone = pairs.select(F.col("b").alias("key"), F.col("a").alias("to")).unionByName(pairs.select(F.col("a").alias("key"), F.col("a").alias("to")))
        tagged = clusters.join(gone, "key", "left").withColumn("to", F.coalesce("to", "key"))
        both = tagged.groupBy("to").agg(F.sort_array(F.collect_list(F.struct("key", "x", "n", "s"))).alias("c"))  # one or two
        clusters = checkpointed(both.select(F.col("to").alias("key"), *_merged(F.col("c"))))
        left, turn = clusters.count(), turn + 1

    def finish_all(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key")
        found = chain_merges(np.stack(part["x"].to_numpy()), part["n"].to_numpy(), part["s"].to_numpy(), part["key"].to_numpy(), kind)
        return pd.DataFrame({"a": [f[0] for f in found], "b": [f[1] for f in found], "h": [f[2] for f in found], "step": np.arange(len(found)) + turn * ROUND_STEPS}).astype({"a": "int64", "b": "int64", "h": "float64", "step": "int64"})

    done.append(clusters.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(finish_all, "a long, b long, h double, step long"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return checkpointed(out)


def _merged(c):
    """Columns x, n, s of one cluster or of two together."""
    a, b = F.get(c, F.lit(0)), F.get(c, F.lit(1))
    size = a["n"] + b["n"]
    gap2 = F.aggregate(F.zip_with(a["x"], b["x"], lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda t, v: t + v)
    x = F.zip_with(a["x"], b["x"], lambda p, q: (p * a["n"] + q * b["n"]) / size)
    s = (a["n"] * a["s"] + b["n"] * b["s"]) / size + a["n"] * b["n"] / (size * size) * gap2
    two = F.size(c) > 1
    return [F.when(two, x).otherwise(a["x"]).alias("x"), F.when(two, size).otherwise(a["n"]).alias("n"), F.when(two, s).otherwise(a["s"]).alias("s")]


def cut_tree(tree: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(key, label) of the ``k`` clusters that are left when the k - 1 highest merges are taken back (all keys of ``points``)."""
    # a merge that builds on another of the same height goes first
    last = tree.orderBy(F.desc("h"), F.desc("step"), "a").limit(max(0, k - 1)).select("a", "b")
    edges = tree.join(F.broadcast(last) if k <= 100_000 else last, ["a", "b"], "left_anti").select("a", "b")
    found = components(edges)
    return points.select("key").join(found.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("comp", "key").alias("label"))


