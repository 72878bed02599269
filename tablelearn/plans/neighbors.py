"""Exact neighbour search for any number of dimensions.

Rows are assigned to the nearest of a bounded set of pivots. The triangle inequality then tells, per query row,
which cells can hold a neighbour; the query row is sent only to those cells. Cells are cut into hash blocks of
bounded size, so a task always sees one query block and one target block, and emits reduced results (the k best,
a count, a spanning forest), never all pairs. The k best are first looked for in the row's own cell, whose k-th
distance then decides which other cells are needed at all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions.columns import feature_array, require
from .blocks import DENSE_ROWS, WIDE_LEFT_ROWS, ClusterSums, Forest, Least, Nearest, Weight, block_pairs, nearest_row, within
from .boxes import Boxes, search
from .farfield import COLUMNS as FAR_COLUMNS, cluster_sums, leaves_for
from .lineage import checkpointed
from .sums import lists_to_matrix

METRICS = ("euclidean", "minkowski", "manhattan", "chebyshev", "cosine")
BLOCK_ROWS = 1_024
MAX_PIVOTS = 2_048
#: Rows of a block whose boxes leave out most of it, and the most columns of such rows.
WIDE_BLOCK_ROWS = 8_192
BOX_COLUMNS = 8
#: Cells that a row may be sent to on average before packed blocks meet instead.
DENSE_COPIES = 16
#: Rows asked how many cells they would be sent to.
ASKED_ROWS = 2_000
#: Numbers of a block's sums per row and cluster.
CLUSTER_SUMS = 2_000_000
#: Different rows up to which all pairs are added up, and the fewest leaves of a tree beyond.
FAR_ROWS = 32_768
FAR_LEAVES = 16


def pieces(batches, rows: int = 1_024):
    """Arrow batches cut short, so that a rows x pivots matrix stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between two small blocks, added up one dimension at a time."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        if metric == "manhattan":
            out += np.abs(gap)
        elif metric == "chebyshev":
            np.maximum(out, np.abs(gap), out=out)
        else:
            out += gap * gap
    return out if metric in ("manhattan", "chebyshev") else np.sqrt(out)


def points(df: DataFrame, id_col: str, cols: list[str], metric: str) -> DataFrame:
    """(id, x): features as one array. Cosine rows are scaled to length 1, where Euclidean order is cosine order."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    require(df, [id_col])
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), feature_array(df, cols).alias("x"))
    if metric == "cosine":
        norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
        rows = rows.withColumn("norm", norm)
        scaled = F.transform("x", lambda v: v / F.col("norm"))
        rows = rows.select("id", F.when(F.col("norm") > 0, scaled).otherwise(F.raise_error(F.lit("cosine needs non-zero rows"))).alias("x"))
    return rows.select("id", F.transform("x", lambda v: v + F.lit(0.0)).alias("x"))


def internal_metric(metric: str) -> str:
    return "euclidean" if metric in ("minkowski", "cosine") else metric


def reported(dist, metric: str):
    """Distance column in the caller's metric."""
    return dist * dist / 2 if metric == "cosine" else dist


def to_internal(eps: float, metric: str) -> float:
    return math.sqrt(2 * eps) if metric == "cosine" else eps


def nearest_block_rows(rows: DataFrame) -> int:
    """Rows (x) of a block in a search for the nearest ones: in few columns boxes leave out most of a large block."""
    first = rows.select("x").first()
    return WIDE_BLOCK_ROWS if first is not None and len(first.x) <= BOX_COLUMNS else BLOCK_ROWS


class PivotCells:
    """Rows (key long, x array, ...) with their pivot cell, plus per-cell row count and radius range."""

    def __init__(self, rows: DataFrame, key: str, metric: str, block_rows: int = BLOCK_ROWS):
        self.metric, self.key, self.block_rows = metric, key, block_rows
        self.spark = rows.sparkSession
        self.total = rows.count()
        wanted = int(min(MAX_PIVOTS, max(1, math.ceil(2 * self.total / block_rows))))
        picked = rows.select("x").orderBy(F.xxhash64(key), key).limit(wanted).collect()  # bounded by MAX_PIVOTS
        if not picked:
            raise ValueError("no rows to search in")
        self.pivots = np.unique(np.array([r.x for r in picked], dtype=float), axis=0)
        self.rows = checkpointed(self._assigned(rows))
        stats = self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi")).collect()
        p = len(self.pivots)
        self.count, self.lo, self.hi = np.zeros(p, dtype=np.int64), np.full(p, np.inf), np.full(p, -np.inf)
        for s in stats:
            self.count[s.cell], self.lo[s.cell], self.hi[s.cell] = s.n, s.lo, s.hi

    def _assigned(self, rows):
        pivots, metric = self.pivots, self.metric
        schema = StructType(list(rows.schema.fields) + [StructField("cell", IntegerType()), StructField("r", DoubleType())])
        at = rows.columns.index("x")

        def assign(batches):
            for batch in pieces(batches):
                cell, r = nearest_row(lists_to_matrix(batch.column(at)), pivots, metric)
                cols = list(batch.columns) + [pa.array(cell.astype(np.int32)), pa.array(r)]
                yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "cell", "r"])

        return rows.mapInArrow(assign, schema)

    def homes(self, queries: DataFrame) -> DataFrame:
        """Each query row once, for the cell of its nearest pivot."""
        return self._assigned(queries).drop("r")

    def route(self, queries: DataFrame, eps: float | None = None, k: int | None = None) -> DataFrame:
        """One copy of each query row per cell that can hold a row within ``eps``, or one of its ``k`` nearest. Rows that have
        been searched for in a cell ``home`` bring the ``bound`` found there and are not sent to it again."""
        searched = "home" in queries.columns
        pivots, metric, count, lo, hi = self.pivots, self.metric, self.count, self.lo, self.hi
        schema = StructType(list(queries.schema.fields) + [StructField("cell", IntegerType())])
        at = queries.columns.index("x")
        slack = 1e-9

        def send(batches):
            for batch in pieces(batches):
                d = distances(lists_to_matrix(batch.column(at)), pivots, metric)
                if eps is not None:
                    bound = np.full(len(d), eps)
                else:  # every row of a cell is at most d + hi away: the first cells that add up to k rows bound the k-th
                    reach = d + np.where(count > 0, hi, np.inf)
                    order = np.argsort(reach, axis=1)
                    filled = np.cumsum(count[order], axis=1) >= min(k, count.sum())
                    bound = np.take_along_axis(reach, order, axis=1)[np.arange(len(d)), filled.argmax(axis=1)]
                if searched:
                    bound = np.fmin(bound, batch.column("bound").to_numpy())
                nearest = np.maximum(np.maximum(d - hi, lo - d), 0.0)
                margin = slack * (1.0 + bound[:, None] + d)
                reached = (nearest <= bound[:, None] + margin) & (count > 0)
                if searched:
                    reached[np.arange(len(d)), batch.column("home").to_numpy()] = False
                row, cell = np.nonzero(reached)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(row)) for c in batch.columns), pa.array(cell.astype(np.int32))],
                    names=[*batch.schema.names, "cell"],
                )

        return queries.mapInArrow(send, schema)

    def crowded(self, queries: DataFrame, key: str, eps: float | None = None, k: int | None = None) -> bool:
        """Whether a query row would go to so many cells that copying it costs more than meeting every block. Some query rows
        are asked; the answer changes the way, not the result."""
        if len(self.pivots) <= DENSE_COPIES:
            return False
        asked = queries.select(key, "x").where(F.pmod(F.xxhash64(key), F.lit(max(1, self.total // ASKED_ROWS))) == 0)
        return self.route(asked, eps, k).count() > DENSE_COPIES * asked.count()

    def block_join(self, routed: DataFrame, query_key: str, work, schema: str, targets: DataFrame | None = None) -> DataFrame:
        """Run ``work(query block, target block)`` for every block pair of every cell.

        Blocks are hash slices of at most about ``block_rows`` rows on both sides, whatever one cell holds.
        """
        targets = self.rows if targets is None else targets
        left = checkpointed(routed)
        size = {r.cell: [r["count"], 0] for r in left.groupBy("cell").count().collect()}
        for r in targets.groupBy("cell").count().collect():
            size.setdefault(r.cell, [0, 0])[1] = r["count"]
        blocks = [
            (c, math.ceil(q / self.block_rows), math.ceil(t / self.block_rows)) for c, (q, t) in size.items() if q and t
        ]
        if not blocks:
            return self.spark.createDataFrame([], schema)
        table = pa.table([pa.array(c, pa.int32()) for c in zip(*blocks)], names=["cell", "nq", "nt"])
        table = F.broadcast(self.spark.createDataFrame(table))  # one row per pivot; as Arrow it needs no job of Python workers
        slice_of = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = left.join(table, "cell").withColumn("qb", slice_of(query_key, "nq")).withColumn("tb", every("nt")).drop("nq", "nt")
        right = targets.join(table, "cell").withColumn("tb", slice_of(self.key, "nt")).withColumn("qb", every("nq")).drop("nq", "nt")
        pair = ["cell", "qb", "tb"]
        return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(work, schema)


def _matrix(table: pa.Table) -> np.ndarray:
    return lists_to_matrix(table.column("x").combine_chunks())


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def knn(train: DataFrame, queries: DataFrame, k: int, metric: str, block_rows: int | None = None) -> DataFrame:
    """(query, neighbor, distance, rank): the k nearest train rows by (distance, id). Inputs are :func:`points`.

    Of identical train rows only the k smallest ids can ever be chosen, so the rest are dropped before the
    search; a hot vector costs at most k rows.
    """
    inner = internal_metric(metric)
    copies = Window.partitionBy("x").orderBy("id")
    unique = checkpointed(train.withColumn("_c", F.row_number().over(copies)).where(F.col("_c") <= k).drop("_c"))
    cells = PivotCells(unique, "id", inner, block_rows or nearest_block_rows(train))
    asking = queries.select(F.col("id").alias("q"), "x")
    w = Window.partitionBy("query").orderBy("d", "neighbor")
    if _crowded_nearest(cells, asking, k):
        state = lambda block: Nearest(block, k, inner)
        found = block_pairs(checkpointed(asking), "q", {"q": "int64"}, cells.rows, "id", {"id": "int64"}, state, "query long, neighbor long, d double",
                            left_rows=WIDE_LEFT_ROWS)
    else:
        first = checkpointed(_nearest_at_home(cells, asking, k))
        found = first.select(F.col("q").alias("query"), F.inline("near"))
        if len(cells.pivots) > 1:
            found = found.unionByName(_nearest_elsewhere(cells, first, k))
    top = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select("query", "neighbor", reported(F.col("d"), metric).alias("distance"), "rank")


def _crowded_nearest(cells: PivotCells, asking: DataFrame, k: int) -> bool:
    """Like :meth:`PivotCells.crowded`, for some query rows that have been searched for in their own cells."""
    if len(cells.pivots) <= DENSE_COPIES:
        return False
    asked = asking.where(F.pmod(F.xxhash64("q"), F.lit(max(1, asking.count() // ASKED_ROWS))) == 0)
    first = checkpointed(_nearest_at_home(cells, asked, k))
    return _away(cells, first, k).count() > DENSE_COPIES * first.count()


def _block_search(q: pa.Table, t: pa.Table, bound: np.ndarray, k: int, metric: str):
    x, target = _matrix(q), Boxes(_matrix(t))
    ids = _ints(t, "id")[target.order]
    least = lambda rows: target.gaps(x[rows], metric)
    exact = lambda rows, at: distances(x[rows], target.x[at], metric)
    row, at, d = search(x, bound, ids, target, k, least, exact)
    return row, ids[at], d


def _nearest_at_home(cells: PivotCells, asking: DataFrame, k: int) -> DataFrame:
    """(u, q, x, home, bound, near): every query row (u) with the k best rows of its own cell and the k-th distance."""
    metric = cells.metric

    def best(q: pa.Table, t: pa.Table) -> pa.Table:
        if not q.num_rows or not t.num_rows:
            return pa.schema([("u", pa.int64()), ("q", pa.int64()), ("x", pa.list_(pa.float64())), ("home", pa.int32()), ("bound", pa.float64()),
                              ("ids", pa.list_(pa.int64())), ("ds", pa.list_(pa.float64()))]).empty_table()
        row, ids, d = _block_search(q, t, np.full(q.num_rows, np.inf), k, metric)
        ends = np.searchsorted(row, np.arange(q.num_rows + 1)).astype(np.int32)
        bound = np.full(q.num_rows, np.inf)
        full = np.diff(ends) == k
        bound[full] = d[ends[1:][full] - 1]
        lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (ids, d)]
        return pa.table([q.column("u"), q.column("q"), q.column("x"), q.column("cell"), pa.array(bound), *lists], names=["u", "q", "x", "home", "bound", "ids", "ds"])

    rows = cells.homes(asking).withColumn("u", F.monotonically_increasing_id())  # one number a row: ids may repeat
    found = cells.block_join(rows, "u", best, "u long, q long, x array<double>, home int, bound double, ids array<long>, ds array<double>")
    near = F.zip_with("ids", "ds", lambda i, d: F.struct(i.alias("neighbor"), d.alias("d"))).alias("near")
    found = found.select("u", "q", "x", "home", "bound", near)
    if cells.count.max() <= cells.block_rows:
        return found
    first = [F.first(c).alias(c) for c in ("q", "x", "home")]  # the same in every slice of the cell
    return found.groupBy("u").agg(*first, F.min("bound").alias("bound"), F.flatten(F.collect_list("near")).alias("near"))


def _away(cells: PivotCells, first: DataFrame, k: int) -> DataFrame:
    return cells.route(first.select("u", "q", "x", "home", "bound"), k=k)


def _nearest_elsewhere(cells: PivotCells, first: DataFrame, k: int) -> DataFrame:
    """(query, neighbor, d): what the other cells hold within the bounds that the own cells gave."""
    metric = cells.metric

    def better(q: pa.Table, t: pa.Table) -> pa.Table:
        schema = pa.schema([("query", pa.int64()), ("neighbor", pa.int64()), ("d", pa.float64())])
        if not q.num_rows or not t.num_rows:
            return schema.empty_table()
        bound = _ints(q, "bound")
        row, ids, d = _block_search(q, t, np.where(np.isnan(bound), np.inf, bound), k, metric)
        return pa.table([_ints(q, "q")[row], ids, d], schema=schema)

    return cells.block_join(_away(cells, first, k), "u", better, "query long, neighbor long, d double")


def weight_within(cells: PivotCells, queries: DataFrame, eps: float) -> DataFrame:
    """(key, weight): total ``w`` of the rows within eps of each query row (key, x)."""
    metric = cells.metric
    if cells.crowded(queries, "key", eps=eps):
        state = lambda block: Weight(block, eps, metric)
        return block_pairs(queries, "key", {"key": "int64"}, cells.rows, "key", {"key": "int64", "w": "int64"}, state, "key long, weight long").groupBy("key").agg(
            F.sum("weight").alias("weight"))

    def count(q: pa.Table, t: pa.Table) -> pa.Table:
        if not q.num_rows or not t.num_rows:
            return pa.schema([("key", pa.int64()), ("weight", pa.int64())]).empty_table()
        near = within(_matrix(q), _matrix(t), metric, eps)
        return pa.table({"key": _ints(q, "key"), "weight": near @ _ints(t, "w")})

    routed = cells.route(queries.select("key", "x"), eps=eps)
    return cells.block_join(routed, "key", count, "key long, weight long").groupBy("key").agg(F.sum("weight").alias("weight"))


def eps_forest(cells: PivotCells, core: DataFrame, eps: float) -> DataFrame:
    """(a, b) edges that connect exactly what the eps-graph over ``core`` rows (key, x, cell) connects.

    Each block pair is reduced to one star per connected piece, so at most one edge per row leaves a task.
    """
    metric = cells.metric
    if cells.crowded(core, "key", eps=eps):
        state = lambda block: Forest(block, eps, metric)
        return block_pairs(core, "key", {"key": "int64"}, core, "key", {"key": "int64"}, state, "a long, b long").distinct()

    def stars(q: pa.Table, t: pa.Table) -> pa.Table:
        none = pa.schema([("a", pa.int64()), ("b", pa.int64())]).empty_table()
        if not q.num_rows or not t.num_rows:
            return none
        near = within(_matrix(q), _matrix(t), metric, eps)
        qk, tk = _ints(q, "key"), _ints(t, "key")
        new_q = near.any(axis=1)
        free_t = near.any(axis=0)
        roots, members = [], []
        for start in np.flatnonzero(new_q):
            if not new_q[start]:
                continue
            front = np.array([start])
            new_q[start] = False
            while len(front):
                reach = np.flatnonzero(near[front].any(axis=0) & free_t)
                free_t[reach] = False
                members.append(tk[reach])
                roots.append(np.full(len(reach), qk[start]))
                front = np.flatnonzero(near[:, reach].any(axis=1) & new_q) if len(reach) else reach
                new_q[front] = False
                members.append(qk[front])
                roots.append(np.full(len(front), qk[start]))
        if not roots:
            return none
        return pa.table({"a": np.concatenate(roots), "b": np.concatenate(members)})

    routed = cells.route(core.select("key", "x"), eps=eps)
    return cells.block_join(routed, "key", stars, "a long, b long", core).where("a != b").distinct()


def smallest_label_within(cells: PivotCells, queries: DataFrame, labelled: DataFrame, eps: float) -> DataFrame:
    """(key, label): the smallest label among ``labelled`` rows (key, x, cell, label) within eps of each query row."""
    metric = cells.metric
    if cells.crowded(queries, "key", eps=eps):
        state = lambda block: Least(block, eps, metric)
        found = block_pairs(queries, "key", {"key": "int64"}, labelled, "key", {"key": "int64", "label": "int64"}, state, "key long, label long")
        return found.groupBy("key").agg(F.min("label").alias("label"))

    def least(q: pa.Table, t: pa.Table) -> pa.Table:
        if not q.num_rows or not t.num_rows:
            return pa.schema([("key", pa.int64()), ("label", pa.int64())]).empty_table()
        near = within(_matrix(q), _matrix(t), metric, eps)
        far = np.iinfo(np.int64).max
        best = np.where(near, _ints(t, "label")[None, :], far).min(axis=1)
        hit = best != far
        return pa.table({"key": _ints(q, "key")[hit], "label": best[hit]})

    routed = cells.route(queries.select("key", "x"), eps=eps)
    return cells.block_join(routed, "key", least, "key long, label long", labelled).groupBy("key").agg(F.min("label").alias("label"))


def mean_silhouette(df: DataFrame, id_col: str, cols: list[str], cluster: str, block_rows: int = DENSE_ROWS, far_rows: int = FAR_ROWS) -> float:
    """Mean Euclidean silhouette. Every different row has its distances to every different row summed by cluster: block by block,
    two at a time; above ``far_rows`` different rows of one or two columns, distant rows together (``plans/farfield.py``), which is
    the same up to a relative 4e-13 of a sum as measured. Copies of a row with the same id count once in the mean."""
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), feature_array(df, cols).alias("x"), F.col(f"`{cluster}`").cast("string").alias("c")
    )
    copies = rows.groupBy("x", "c", "id").count()
    unique = checkpointed(copies.groupBy("x", "c").agg(F.sum("count").alias("w"), F.count(F.lit(1)).alias("ids")))
    sizes = {r.c: r.n for r in unique.groupBy("c").agg(F.sum("w").alias("n")).collect()}
    code = F.broadcast(df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(sorted(sizes))], "c string, code long"))  # one row per cluster
    unique = checkpointed(
        unique.join(code, "c").select("x", F.col("code").alias("c"), "w", "ids", F.xxhash64("x", "c").alias("key"))
    )
    size, k = np.array([sizes[c] for c in sorted(sizes)], dtype=float), len(sizes)

    def told(own, ids, s):
        at = np.arange(len(own))
        a = s[at, own] / np.maximum(size[own] - 1, 1)
        far = s / size
        far[at, own] = np.inf
        b = far.min(axis=1)
        top = np.maximum(a, b)
        value = np.where((size[own] == 1) | (top == 0), 0.0, (b - a) / np.where(top == 0, 1.0, top))
        return pa.table({"n": [int(ids.sum())], "v": [float(ids @ value)]})

    found = _far_silhouettes(unique, k, far_rows, told)
    if found is None:
        block_rows = max(1, min(block_rows, CLUSTER_SUMS // k))
        state = lambda block: ClusterSums(block, k)
        sums = block_pairs(
            unique, "key", {"key": "int64", "c": "int64", "ids": "int64"}, unique, "key", {"c": "int64", "w": "int64"}, state,
            "key long, sums binary, c binary, ids binary", block_rows,
        )

        def values(part):
            whole = lambda name, kind: np.frombuffer(part.column(name)[0].as_buffer(), dtype=kind)
            own = whole("c", "int64")
            s = sum(np.frombuffer(v.as_buffer(), dtype=float) for v in part.column("sums")).reshape(len(own), k)
            return told(own, whole("ids", "int64"), s)

        found = sums.groupBy("key").applyInArrow(values, "n long, v double")
    return found.agg(F.sum("v") / F.sum("n")).first()[0]


def _far_silhouettes(unique: DataFrame, k: int, far_rows: int, told) -> DataFrame | None:
    """(n, v) of the leaves, where the rows are many and of few columns and the clusters not too many for a fine tree."""
    n = unique.count()
    columns = len(unique.first().x) if n > far_rows else 0
    leaves = leaves_for(n, k, columns) if 0 < columns <= FAR_COLUMNS else 0
    return cluster_sums(unique, n, k, leaves, told, "n long, v double") if leaves >= FAR_LEAVES else None
