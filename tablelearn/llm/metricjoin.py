"""Exact cosine range join: pivots partition the vectors, the triangle inequality sets what crosses a border."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablelearn.plans.blocks import OPEN_SHARE, TILE_COLUMNS, marked, tiles
from tablelearn.plans.components import components
from tablelearn.plans.lineage import checkpointed
from tablelearn.plans.neighbors import pieces
from tablelearn.plans.sums import lists_to_matrix

THRESHOLD = 0.95
#: Vectors per pivot, and vectors of a block.
CELL_ROWS = 8192
BLOCK_ROWS = 8192
#: Numbers of a block, and of the blocks that one task holds on its right side.
BLOCK_NUMBERS = 1 << 20
SLICE_NUMBERS = 1 << 24
MAX_PIVOTS = 1024
_SLACK = 1e-9
_PACKED = "block int, cell int, x binary, bytes int, name binary, many binary, reaches array<int>"


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _gaps(pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * np.clip(pivots @ pivots.T, -1, 1)))


def crossing(x: np.ndarray, own: int, pivots: np.ndarray, gaps: np.ndarray, reach: float) -> np.ndarray:
    """Mask of the other cells in which a partner of each row of cell ``own`` may lie.

    A partner y of x in cell j is no nearer to pivot i than to j, so x.p_i - x.p_j <= (x - y).(p_i - p_j) <=
    reach |p_i - p_j|. The same holds for y, so a pair needs both of its rows to cross.
    """
    near = x @ pivots.T
    cross = near[:, own][:, None] - near <= reach * gaps[own] + _SLACK
    cross[:, own] = False
    return cross


class Links:
    """Partners of the rows of a left block among the rows of right blocks, and a forest of them.

    Rows come as (name, links, root): links counts partners with their copies, root is a left row's name of the same
    component. A right block's rows are told by ``add``, the left rows by ``rows`` at the end.
    """

    def __init__(self, block: dict, threshold: float):
        self.x, self.names, self.many, self.threshold = block["x"], block["name"], block["many"], threshold
        self.single = self.x.astype(np.float32)
        self.off = 4.0 * (self.x.shape[1] + 8) * 2.0**-24  # what single precision may take from a product of unit rows
        self.links, self.root = np.zeros(len(self.x), np.int64), np.arange(len(self.x))

    def _pairs(self, rows: np.ndarray, b: np.ndarray, same: bool):
        """(place in ``rows``, place in ``b``) of linked rows, in parts of a tile; in the same block each pair once."""
        x, single = self.x[rows], self.single[rows]
        factor = np.ascontiguousarray(b.astype(np.float32).T)
        for s in tiles(len(rows)):
            for start in range(s.start - s.start % TILE_COLUMNS if same else 0, len(b), TILE_COLUMNS):
                i, j = marked(single[s] @ factor[:, start:start + TILE_COLUMNS] >= np.float32(self.threshold - self.off))
                if not len(i):
                    continue
                near, far = x[s], b[start:start + TILE_COLUMNS]
                if len(i) > OPEN_SHARE * len(near) * len(far):
                    i, j = np.nonzero(near @ far.T >= self.threshold)
                else:
                    hit = np.einsum("ij,ij->i", near[i], far[j]) >= self.threshold
                    i, j = i[hit], j[hit]
                i, j = i + s.start, j + start
                if same:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    yield i, j

    def within(self) -> None:
        """Meet the block's own rows."""
        for i, j in self._pairs(np.arange(len(self.x)), self.x, True):
            np.add.at(self.links, i, self.many[j])
            np.add.at(self.links, j, self.many[i])
            merge(self.root, i, j)

    def add(self, block: dict, rows: np.ndarray, others: np.ndarray) -> pa.RecordBatch | None:
        """Meet the rows at ``others`` of another block with the left rows at ``rows``."""
        if not len(rows) or not len(others):
            return None
        n, links = len(self.x), np.zeros(len(others), np.int64)
        root = np.concatenate([self.root, np.arange(n, n + len(others))])
        for i, j in self._pairs(rows, block["x"][others], False):
            np.add.at(self.links, rows[i], block["many"][others[j]])
            np.add.at(links, j, self.many[rows[i]])
            merge(root, rows[i], n + j)
        hit = np.flatnonzero(links)
        if not len(hit):
            return None
        self.root = root[:n]  # of a component the smallest place, which is a left row's
        return _told(block["name"][others[hit]], links[hit], self.names[root[n + hit]])

    def rows(self) -> pa.RecordBatch:
        hit = self.links > 0
        return _told(self.names[hit], self.links[hit], self.names[self.root[hit]])


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of the places ``a`` and ``b``; ``root`` is the smallest place of each one."""
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def _told(names, links, roots) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array(links), pa.array(roots)], names=["name", "links", "root"])


def similar_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                    cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row; two rows link if their cosine is at least ``threshold``.

    Equal vectors are joined once as a class with its number of copies. Each class goes to the cell of its nearest
    pivot; cells are cut into blocks that are packed once. Two blocks meet if the triangle inequality leaves rows of both
    open, and then only with these rows; a task holds a bounded number of blocks and returns counts and a spanning forest,
    never its pairs. Single precision leaves out most pairs, double precision decides the rest.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. A null id has no links, no component and is not kept. Rows repeated whole link with each other.
    """
    spark, reach = rows.sparkSession, float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    table = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda v: v != 0)
    table = table.withColumn("vec", F.when(F.coalesce(usable, F.lit(False)), F.col("vec")))
    classes = table.where("vec IS NOT NULL").groupBy("vec").agg(F.min("vec_id").alias("name"), F.count(F.lit(1)).alias("many"))
    classes = checkpointed(classes.withColumn("dim", F.size("vec")))
    edges = counts = None
    for dim, total in sorted((r["dim"], r["n"]) for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()):
        found = checkpointed(_joined(classes.where(F.col("dim") == dim), total, threshold, reach, cell_rows, block_rows))
        edges = found if edges is None else edges.unionByName(found)
    if edges is None:
        edges = spark.createDataFrame([], "name long, links long, root long")
    counts = edges.groupBy("name").agg(F.sum("links").alias("links"))
    groups = components(edges.where("name <> root").select(F.col("name").alias("a"), F.col("root").alias("b")), finish_edges=0)
    told = classes.join(counts, "name", "left").join(groups.withColumnRenamed("node", "name"), "name", "left").select(
        F.col("vec").alias("_vec"), (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
        F.coalesce("comp", "name").alias("comp"))
    out = table.join(told, F.col("vec") == F.col("_vec"), "left")
    own = F.coalesce("comp", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))


def _joined(classes: DataFrame, total: int, threshold: float, reach: float, cell_rows: int, block_rows: int) -> DataFrame:
    number = min(MAX_PIVOTS, max(1, -(-total // cell_rows)))
    picked = classes.orderBy(F.xxhash64("name"), "name").limit(number).collect()
    pivots = _unit(np.array([r["vec"] for r in picked], dtype=np.float64))
    block_rows = max(1, min(block_rows, BLOCK_NUMBERS // pivots.shape[1]))
    packed, blocks = packed_blocks(classes, pivots, reach, block_rows)
    slices = -(-blocks // max(1, SLICE_NUMBERS // (block_rows * pivots.shape[1])))
    return _met(checkpointed(packed.repartition(slices)), blocks, slices, pivots, threshold, reach)


def packed_blocks(classes: DataFrame, pivots: np.ndarray, reach: float, block_rows: int) -> tuple[DataFrame, int]:
    """Every row (name, many, vec) once: hash blocks of its cell as bytes, with the cells that one of their rows may have a
    partner in; and the number of blocks, some of which may be empty."""
    number, gaps, vec = len(pivots), _gaps(pivots), classes.schema["vec"].dataType.simpleString()

    def nearest(batch) -> np.ndarray:
        return (_unit(lists_to_matrix(batch.column("vec"))) @ pivots.T).argmax(axis=1)

    def tally(batches):
        held = np.zeros(number, np.int64)
        for batch in pieces(batches):
            held += np.bincount(nearest(batch), minlength=number)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(number)), pa.array(held)], names=["cell", "n"])

    cuts = np.ones(number, np.int64)  # at least one, as a row between equal pivots may be found in either
    for r in classes.select("vec").mapInArrow(tally, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # one row per pivot
        cuts[r["cell"]] = max(1, -(-r["n"] // block_rows))
    first = np.cumsum(cuts) - cuts

    def place(batches):
        for batch in pieces(batches):
            cell = nearest(batch)
            block = first[cell] + batch.column("spot").to_numpy() % cuts[cell]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("name", "many", "vec")), pa.array(block.astype(np.int32)), pa.array(cell.astype(np.int32))],
                names=["name", "many", "vec", "block", "cell"])

    def pack(group, part):
        x = lists_to_matrix(part.column("vec").combine_chunks()).astype(np.float64)
        with np.errstate(over="ignore"):
            short = x.astype(np.float32)
        raw, cell, reached = short if np.array_equal(short, x) else x, part.column("cell")[0].as_py(), np.zeros(number, bool)
        for s in tiles(len(x)):
            reached |= crossing(_unit(x[s]), cell, pivots, gaps, reach).any(axis=0)
        numbers = [pa.array([part.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary()) for c in ("name", "many")]
        return pa.table([
            pa.array([group[0].as_py()], pa.int32()), pa.array([cell], pa.int32()), pa.array([raw.tobytes()], pa.binary()), pa.array([raw.itemsize], pa.int32()),
            *numbers, pa.array([np.flatnonzero(reached).astype(np.int32)], pa.list_(pa.int32()))], names=["block", "cell", "x", "bytes", "name", "many", "reaches"])

    spread = classes.select("name", "many", "vec", F.pmod(F.xxhash64("name"), F.lit(1 << 20)).alias("spot"))
    placed = spread.mapInArrow(place, f"name long, many long, vec {vec}, block int, cell int")
    return placed.groupBy("block").applyInArrow(pack, _PACKED), int(cuts.sum())


def _read(batch, at: int, side: str) -> dict:
    whole = lambda name, kind: np.frombuffer(batch.column(f"{side}_{name}")[at].as_buffer(), dtype=kind)
    out = {n: whole(n, np.int64) for n in ("name", "many")}
    kind = np.float32 if batch.column(f"{side}_bytes")[at].as_py() == 4 else np.float64
    out["x"] = _unit(whole("x", kind).reshape(len(out["name"]), -1))
    return out


def _met(packed: DataFrame, blocks: int, slices: int, pivots: np.ndarray, threshold: float, reach: float) -> DataFrame:
    """name, links, root of the rows with partners: a task meets one block on the left with a slice of blocks on the right.
    Two blocks meet in one of the two orders, dealt so that every left block meets about half of the others."""
    gaps = _gaps(pivots)
    named = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
    ours = named(packed, "q").repartitionByRange(blocks, "q_block")
    theirs = named(packed.coalesce(slices), "t")
    turn = (F.col("q_block") < F.col("t_block")) == ((F.col("q_block") + F.col("t_block")) % 2 == 1)
    reached = F.array_contains("q_reaches", F.col("t_cell")) & F.array_contains("t_reaches", F.col("q_cell"))
    pairs = ours.join(theirs.hint("shuffle_replicate_nl"), turn & ((F.col("q_cell") == F.col("t_cell")) | reached))

    def inside(x: np.ndarray, own: int, other: int) -> np.ndarray:
        if own == other:
            return np.arange(len(x))
        return np.flatnonzero(crossing(x, 0, pivots[[own, other]], gaps[np.ix_([own, other], [own, other])], reach)[:, 1])

    def run(batches):
        at, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                q, t, mine, cell = (batch.column(c)[i].as_py() for c in ("q_block", "t_block", "q_cell", "t_cell"))
                if q != at:
                    if held is not None:
                        yield held.rows()
                    at, held = q, Links(_read(batch, i, "q"), threshold)
                if q == t:
                    held.within()
                    continue
                other = _read(batch, i, "t")
                found = held.add(other, inside(held.x, mine, cell), inside(other["x"], cell, mine))
                if found is not None:
                    yield found
        if held is not None:
            yield held.rows()

    wanted = [f"{side}_{c}" for side in "qt" for c in ("block", "cell", "x", "bytes", "name", "many")]
    return pairs.select(*wanted).mapInArrow(run, "name long, links long, root long")
