"""All rows against all rows where no cell can be left out: packed blocks meet in a cartesian product.

A block is one table row holding its rows' numbers as bytes. A task reads one block on the left and one slice of blocks on
the right, keeps a reduced state per left block (the k best, a count, a forest, sums) and returns only that, so no row is
copied through a shuffle and memory is bounded by a few blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .lineage import checkpointed

#: Rows of a block, and blocks of a slice that one task reads.
DENSE_ROWS = 4_096
SLICE_BLOCKS = 32
LEFT_BLOCKS = 48
#: Rows of a left block where little is kept per row: both blocks of a pair are handed to Python, so few large ones cost less.
WIDE_LEFT_ROWS = 16_384
#: Rows of a tile, whose distances to one block are held at once, and columns of the product that stay in a core's cache.
TILE_ROWS = 512
TILE_COLUMNS = 512
#: Share of a tile's pairs that single precision may leave open before double precision is asked.
OPEN_SHARE = 1 / 64
FAR = np.iinfo(np.int64).max


def packed(rows: DataFrame, key: str, numbers: dict[str, str], blocks: int) -> DataFrame:
    """(block, x, bytes, ...): hash blocks of ``rows`` (x array, ...); ``numbers`` names the other columns and their numpy types.
    A block whose numbers single precision holds exactly has 4 ``bytes`` for each, others 8."""

    def pack(group, part):
        out = {"block": pa.array([group[0].as_py()], pa.int32())}
        x = part.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
        with np.errstate(over="ignore"):
            short = x.astype(np.float32)
        x = short if np.array_equal(short, x) else x
        out["x"], out["bytes"] = pa.array([x.tobytes()], pa.binary()), pa.array([x.itemsize], pa.int32())
        for name, kind in numbers.items():
            if part.column(name).null_count:
                raise ValueError(f"missing value in column {name}")
            out[name] = pa.array([part.column(name).to_numpy().astype(kind).tobytes()], pa.binary())
        return pa.table(out)

    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block")
    schema = "block int, x binary, bytes int, " + ", ".join(f"{n} binary" for n in numbers)
    return rows.select("x", *numbers, block).groupBy("block").applyInArrow(pack, schema)


def _read(batch, at: int, side: str, numbers: dict[str, str]) -> dict:
    """The numbers of one packed block, copied only where they are sent in single precision."""
    out = {n: np.frombuffer(batch.column(f"{side}_{n}")[at].as_buffer(), dtype=kind) for n, kind in numbers.items()}
    kind = np.float32 if batch.column(f"{side}_bytes")[at].as_py() == 4 else float
    flat = np.frombuffer(batch.column(f"{side}_x")[at].as_buffer(), dtype=kind)
    out["x"] = flat.astype(float, copy=False).reshape(len(next(iter(out.values()))), -1)
    return out


def block_pairs(left: DataFrame, key: str, left_numbers: dict, right: DataFrame, right_key: str, right_numbers: dict, state, schema: str,
                block_rows: int = DENSE_ROWS, *, left_rows: int | None = None) -> DataFrame:
    """For every left block a ``state(block)`` that is given every right block by ``add`` and told by ``rows``.

    A left block is told once per slice of the right side, so the caller combines a few results per row.
    """
    n_left, n_right = left.count(), right.count()
    size = min(left_rows or block_rows, max(TILE_ROWS, math.ceil(n_left / LEFT_BLOCKS)))
    n_blocks, r_blocks = max(1, math.ceil(n_left / size)), max(1, math.ceil(n_right / block_rows))
    slices = math.ceil(r_blocks / SLICE_BLOCKS)
    named = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
    ours = named(packed(left, key, left_numbers, n_blocks).repartitionByRange(n_blocks, "block"), "q")
    theirs = named(checkpointed(packed(right, right_key, right_numbers, r_blocks).repartition(slices)).coalesce(slices), "t")

    def run(batches):
        at, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("q_block")[i].as_py()
                if block != at:
                    if held is not None:
                        yield held.rows()
                    at, held = block, state(_read(batch, i, "q", left_numbers))
                held.add(_read(batch, i, "t", right_numbers))
        if held is not None:
            yield held.rows()

    return checkpointed(ours.crossJoin(theirs.hint("shuffle_replicate_nl")).mapInArrow(run, schema))


def lengths(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Euclidean distances of single pairs, added up one dimension at a time like ``neighbors.distances``."""
    out = np.zeros(len(i))
    for c in range(a.shape[1]):
        gap = a[i, c] - b[j, c]
        out += gap * gap
    return np.sqrt(out)


def squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by one matrix product, and a bound on how far they lie from the added-up ones."""
    aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    out = a @ b.T
    out *= -2.0
    out += aa[:, None]
    out += bb[None, :]
    most = (aa.max() + bb.max()) if len(aa) and len(bb) else 0.0
    return out, 8.0 * (a.shape[1] + 8) * 2.0**-53 * most


def by_product(a: np.ndarray, b: np.ndarray, metric: str) -> bool:
    """Whether :func:`squares` can decide most pairs."""
    return metric == "euclidean" and a.shape[1] > 3 and _moderate(a) and _moderate(b)


def _moderate(a: np.ndarray) -> bool:
    return bool(max(a.max(), -a.min()) < 1e150)  # NaN is not


def nearest_row(a: np.ndarray, b: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``b``, distance) of a nearest row of ``b`` for every row of ``a``. In many columns a matrix product picks it, so of
    rows that are equally near up to rounding any may be taken; the distance is that of the row taken."""
    from .neighbors import distances

    at = np.arange(len(a))
    if not len(a) or not by_product(a, b, metric):
        d = distances(a, b, metric)
        found = d.argmin(axis=1)
        return found, d[at, found]
    found = squares(a, b)[0].argmin(axis=1)
    return found, lengths(a, b, at, found)


def within(a: np.ndarray, b: np.ndarray, metric: str, eps: float) -> np.ndarray:
    """``distances(a, b, metric) <= eps``; in many columns only pairs that a matrix product leaves open are added up."""
    from .neighbors import distances

    if not len(a) or not len(b) or not by_product(a, b, metric):
        return distances(a, b, metric) <= eps
    g, off = squares(a, b)
    limit = eps * eps
    off += 8 * 2.0**-53 * limit
    near = g <= limit
    g -= limit
    i, j = np.nonzero(np.abs(g, out=g) <= off)
    near[i, j] = lengths(a, b, i, j) <= eps
    return near


def marked(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the few places that are true, looked for in groups of eight."""
    flat = near.ravel()
    if flat.size % 8:
        return np.nonzero(near)
    groups = np.flatnonzero(flat.view(np.uint64) != 0)
    group, place = np.nonzero(flat.reshape(-1, 8)[groups])
    return np.divmod(groups[group] * 8 + place, near.shape[1])


def tiles(n: int):
    return (slice(s, s + TILE_ROWS) for s in range(0, n, TILE_ROWS))


class Rough:
    """Squared distances of left rows to other rows, less the left row's own square, by one matrix product in single precision
    around the middle of the left rows."""

    def __init__(self, a: np.ndarray):
        self.middle = a.mean(axis=0)
        a = a - self.middle
        self.own = np.einsum("ij,ij->i", a, a)
        self.left = np.hstack([a, np.ones((len(a), 1))]).astype(np.float32)

    def right(self, b: np.ndarray) -> tuple[np.ndarray, float] | None:
        """The other factor for the rows ``b``, and a bound on how far the product lies from the added-up squares; none where
        single precision does not reach."""
        b = b - self.middle
        bb = np.einsum("ij,ij->i", b, b)
        most = self.own.max() + bb.max()
        if not 1e-25 < most < 1e30:
            return None
        return np.hstack([-2.0 * b, bb[:, None]]).astype(np.float32).T, 8.0 * (b.shape[1] + 8) * 2.0**-24 * most


class Nearest:
    """The k nearest right rows (id) of every left row (q) by (distance, id)."""

    def __init__(self, block, k: int, metric: str):
        self.q, self.x, self.k, self.metric = block["q"], block["x"], k, metric
        self.row, self.id, self.d = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.bound, self.seen = np.full(len(self.q), np.inf), 0
        self.rough = Rough(self.x) if len(self.x) and by_product(self.x, self.x, metric) else None

    def _limit(self, g, limit, off):
        """``limit``, or the k-th of the left row's numbers where it has none yet."""
        if g.shape[1] > self.k and not np.isfinite(limit).all():
            return np.minimum(limit, np.partition(g, self.k - 1, axis=1)[:, self.k - 1] + 2 * off)
        return limit

    def _roughly(self, s, factor, off):
        """Pairs of the tile that single precision leaves open; none where these are many."""
        left, n = self.rough.left[s], factor.shape[1]
        bound = self.bound[s]
        limit = bound * bound * (1 + 1e-12) + off - self.rough.own[s]
        found, most = [], max(OPEN_SHARE * len(left) * n, 4 * self.k * len(left))
        for start in range(0, n, TILE_COLUMNS):
            g = left @ factor[:, start:start + TILE_COLUMNS]
            limit = self._limit(g, limit, off)
            i, j = marked(g <= np.nextafter(limit.astype(np.float32), np.float32(np.inf))[:, None])
            most -= len(i)
            if most < 0:
                return None
            found.append((i, j + start))
        return tuple(np.concatenate(c) for c in zip(*found))

    def _near(self, s, x, product, rough):
        """(row of the tile, row of x, distance) of the pairs that can be among the k nearest."""
        from .neighbors import distances

        a, bound = self.x[s], self.bound[s]
        if not product:
            d = distances(a, x, self.metric)
            i, j = np.nonzero(~(d > self._limit(d, bound, 0.0)[:, None]))
            return i, j, d[i, j]
        found = self._roughly(s, *rough) if rough else None
        if found is None:
            g, off = squares(a, x)
            found = np.nonzero(g <= self._limit(g, bound * bound * (1 + 1e-12) + off, off)[:, None])
        return *found, lengths(a, x, *found)

    def add(self, t):
        start = 0
        while start < len(t["id"]):  # the rows seen bound as many others
            end = start + max(TILE_COLUMNS, self.seen)
            self._add(t["id"][start:end], t["x"][start:end])
            start, self.seen = end, self.seen + end - start

    def _add(self, ids, x):
        product = self.rough is not None and _moderate(x)
        rough = self.rough.right(x) if product else None
        found = []
        for s in tiles(len(self.q)):
            i, j, d = self._near(s, x, product, rough)
            found.append((i + s.start, ids[j], d))
        met = np.zeros(len(self.q), bool)
        for row, _, _ in found:
            met[row] = True
        old = met[self.row]
        row, key, d = (np.concatenate(c) for c in zip((self.row[old], self.id[old], self.d[old]), *found))
        order = np.lexsort((key, d, row))
        row, key, d = row[order], key[order], d[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep, last = place < self.k, place == self.k - 1
        both = [np.concatenate([was[~old], now[keep]]) for was, now in ((self.row, row), (self.id, key), (self.d, d))]
        order = np.argsort(both[0], kind="stable")
        self.row, self.id, self.d = (c[order] for c in both)
        self.bound[row[last]] = np.where(np.isnan(d[last]), np.inf, d[last])

    def rows(self):
        return pa.RecordBatch.from_arrays([pa.array(self.q[self.row]), pa.array(self.id), pa.array(self.d)], names=["query", "neighbor", "d"])


class Weight:
    """Total ``w`` of the right rows within eps of every left row."""

    def __init__(self, block, eps: float, metric: str):
        self.key, self.x, self.eps, self.metric = block["key"], block["x"], eps, metric
        self.total = np.zeros(len(self.key), np.int64)

    def add(self, t):
        for s in tiles(len(self.key)):
            near = within(self.x[s], t["x"], self.metric, self.eps)
            i, j = np.nonzero(near)
            np.add.at(self.total, i + s.start, t["w"][j])

    def rows(self):
        return pa.RecordBatch.from_arrays([pa.array(self.key), pa.array(self.total)], names=["key", "weight"])


class Forest:
    """Edges that connect what the eps-graph between the left block and the right rows connects: every linked right row hangs
    on one left row, and left rows that share a right row hang on one of them."""

    def __init__(self, block, eps: float, metric: str):
        self.key, self.x, self.eps, self.metric = block["key"], block["x"], eps, metric
        self.root = np.arange(len(self.key))
        self.least = self.key.min() if len(self.key) else 0
        self.a, self.b = [], []

    def add(self, t):
        mine = t["key"] >= self.least  # the other direction sees the rest: the graph is symmetric
        keys, x = t["key"][mine], t["x"][mine]
        if not len(keys):
            return
        links = [np.nonzero(within(self.x[s], x, self.metric, self.eps)) for s in tiles(len(self.key))]
        i = np.concatenate([p[0] + n * TILE_ROWS for n, p in enumerate(links)])
        j = np.concatenate([p[1] for p in links])
        if not len(i):
            return
        one, first = np.unique(j, return_index=True)
        self.a.append(self.key[i[first]])
        self.b.append(keys[one])
        while True:  # the smallest root that meets a right row takes the others that do
            least, root = np.full(len(keys), len(self.key)), np.arange(len(self.key))
            np.minimum.at(least, j, self.root[i])
            np.minimum.at(root, self.root[i], least[j])
            while (root[root] != root).any():
                root = root[root]
            if (root[self.root] == self.root).all():
                return
            self.root = root[self.root]

    def rows(self):
        a, b = np.concatenate([*self.a, self.key[self.root]]), np.concatenate([*self.b, self.key])
        return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])


class Least:
    """The smallest ``label`` of the right rows within eps of every left row; rows without one are left out."""

    def __init__(self, block, eps: float, metric: str):
        self.key, self.x, self.eps, self.metric = block["key"], block["x"], eps, metric
        self.best = np.full(len(self.key), FAR)

    def add(self, t):
        for s in tiles(len(self.key)):
            i, j = np.nonzero(within(self.x[s], t["x"], self.metric, self.eps))
            np.minimum.at(self.best, i + s.start, t["label"][j])

    def rows(self):
        hit = self.best != FAR
        return pa.RecordBatch.from_arrays([pa.array(self.key[hit]), pa.array(self.best[hit])], names=["key", "label"])


class ClusterSums:
    """Sum of the distances from every left row to the right rows of each cluster (code ``c``, ``w`` copies)."""

    def __init__(self, block, clusters: int):
        self.block, self.x = block, block["x"]
        self.sums = np.zeros((len(self.x), clusters))

    def add(self, t, wide: int = 4_096, high: int = 16):
        order = np.argsort(t["c"], kind="stable")
        code, w = t["c"][order], t["w"][order].astype(float)
        mine, theirs = np.ascontiguousarray(self.x.T), np.ascontiguousarray(t["x"][order].T)
        cuts = np.append(0, np.flatnonzero(np.diff(code)) + 1)
        gap, d = np.empty((high, wide)), np.empty((high, wide))  # both stay in a core's cache
        for start in range(0, len(code), wide):
            end = min(start + wide, len(code))
            inside = np.unique(np.clip(np.append(cuts, len(code)), start, end))
            for s in range(0, len(self.x), high):
                rows = min(high, len(self.x) - s)
                g, out = gap[:rows, :end - start], d[:rows, :end - start]
                for j, (a, b) in enumerate(zip(mine, theirs)):
                    into = g if j else out
                    np.subtract(a[s:s + rows, None], b[None, start:end], out=into)
                    np.multiply(into, into, out=into)
                    if j:
                        np.add(out, g, out=out)
                np.sqrt(out, out=out)
                for lo, hi in zip(inside, inside[1:]):
                    self.sums[s:s + rows, code[lo]] += out[:, lo - start:hi - start] @ w[lo:hi]

    def rows(self):
        as_bytes = lambda v: pa.array([v.tobytes()], pa.binary())
        key = pa.array([int(self.block["key"].min())])
        return pa.RecordBatch.from_arrays([key, as_bytes(self.sums), as_bytes(self.block["c"]), as_bytes(self.block["ids"])], names=["key", "sums", "c", "ids"])
