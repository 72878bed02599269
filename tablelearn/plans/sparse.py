"""Leading singular vectors of wide sparse rows: block power passes over the rows, a tall-skinny QR over the columns' table.

Nothing of the size columns x columns is built, and the driver sees only small triangles. Rows are (index, value) pairs of
arrays; equal indices within a row add up, columns that never occur cost nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .lineage import checkpointed
from .skew import hot_safe_join
from .sums import lists_to_matrix

#: Up to so many numbers, the vectors go to every task; beyond, entries meet them in a join.
SENT_NUMBERS = 4_000_000
#: Entries of rows that are multiplied at once.
_ENTRIES = 100_000


def sparse_entries(df: DataFrame, name: str) -> tuple[Column, Column]:
    """Index and value arrays of a vector column, of an array of numbers, or of a map from column number to value."""
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, T.MapType):
        return F.map_keys(col).cast("array<long>"), F.map_values(col).cast("array<double>")
    if isinstance(kind, T.ArrayType):
        index, value = _places(col), col.cast("array<double>")
    elif kind.typeName() == "vectorudt" or type(kind).__name__ == "VectorUDT":
        plain = F.unwrap_udt(col)
        index, value = F.coalesce(plain["indices"].cast("array<long>"), _places(plain["values"])), plain["values"]
    else:
        raise ValueError(f"{name} must be a vector, an array or a map")
    return index, value


def _places(values: Column) -> Column:
    return F.transform(values, lambda _v, i: i.cast("long"))


def products(index: np.ndarray, value: np.ndarray, sizes: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sparse rows, given as positions in ``basis``, values and lengths, times ``basis``."""
    out = np.zeros((len(sizes), basis.shape[1]))
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        first = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, first + _ENTRIES, side="right")))
        filled = start + np.flatnonzero(sizes[start:stop])
        if len(filled):
            part = value[first:ends[stop - 1], None] * basis[index[first:ends[stop - 1]]]
            out[filled] = np.add.reduceat(part, ends[filled] - sizes[filled] - first, axis=0)
        start = stop
    return out


def _add_back(total, index, value, sizes, scores):
    """total += rows' * scores."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    for start in range(0, len(index), _ENTRIES):
        at = index[start:start + _ENTRIES]
        order = np.argsort(at, kind="stable")
        part = value[start:start + _ENTRIES, None] * scores[row[start:start + _ENTRIES]]
        heads = np.flatnonzero(np.diff(at[order], prepend=-1))
        total[at[order][heads]] += np.add.reduceat(part[order], heads, axis=0)


def batch_arrays(batch, columns: np.ndarray):
    """Positions in ``columns``, values and row lengths of an Arrow batch (index, value); unknown columns are left out."""
    lists, values = batch.column(0), batch.column(1)
    sizes = np.array(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    index = lists.flatten().to_numpy(zero_copy_only=False)
    value = values.flatten().to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(columns, index), max(len(columns) - 1, 0))
    known = columns[at] == index if len(columns) else np.zeros(len(index), bool)
    if not known.all():
        row = np.repeat(np.arange(len(sizes)), sizes)
        sizes = np.bincount(row[known], minlength=len(sizes))
        at, value = at[known], value[known]
    return at, value, sizes


def collected_basis(basis: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The table (col, v) as sorted column numbers and their rows; only for tables whose size was checked."""
    got = basis.toArrow()
    columns, block = got.column("col").to_numpy(), lists_to_matrix(got.column("v").combine_chunks())
    order = np.argsort(columns)
    return columns[order], block[order]


def _turned(block: DataFrame, turn: np.ndarray) -> DataFrame:
    @F.pandas_udf("array<double>")
    def apply(v: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(v.to_numpy()) @ turn)) if len(v) else v

    return block.select("col", apply("v").alias("v"))


def tall_qr(block: DataFrame, width: int) -> np.ndarray:
    """R of the QR of all rows v: each task folds its batches into one triangle, the driver folds one triangle a task."""

    def fold(batches):
        r = np.zeros((0, width))
        for batch in batches:
            if batch.num_rows:
                r = np.linalg.qr(np.vstack([r, lists_to_matrix(batch.column(0))]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()], pa.list_(pa.float64()))], names=["r"])

    parts = [np.array(x.r).reshape(-1, width) for x in block.select("v").mapInArrow(fold, "r array<double>").collect()]
    return np.linalg.qr(np.vstack(parts), mode="r") if parts else np.zeros((0, width))


def _orthonormal(block: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The matrix that makes the columns orthonormal, longest first, and their lengths."""
    _u, size, vt = np.linalg.svd(tall_qr(block, width), full_matrices=False)
    keep = size > 1e-12 * size.max(initial=0.0)
    return vt[keep].T / size[keep], size[keep]


def _pass_sent(rows: DataFrame, basis: DataFrame, width: int) -> DataFrame:
    columns, block = collected_basis(basis)

    def work(batches):
        total = np.zeros((len(columns), width))
        for batch in batches:
            if batch.num_rows:
                index, value, sizes = batch_arrays(batch, columns)
                _add_back(total, index, value, sizes, products(index, value, sizes, block))
        met = np.flatnonzero(total.any(axis=1))
        for start in range(0, len(met), 10_000):
            at = met[start:start + 10_000]
            flat = pa.array(total[at].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * width), flat)
            yield pa.RecordBatch.from_arrays([pa.array(columns[at]), lists], names=["col", "v"])

    return _summed(rows.select("index", "value").mapInArrow(work, "col long, v array<double>"), "col", width, F.col("v"))


def _pass_joined(entries: DataFrame, basis: DataFrame, width: int) -> DataFrame:
    """The same by joins: a frequent column is a hot key of the first, a long row is one of the second."""
    met = hot_safe_join(entries, basis, ["col"])
    scores = _summed(met.withColumn("v", F.transform("v", lambda x: x * F.col("x"))), "row", width, F.col("v"))
    back = hot_safe_join(entries, checkpointed(scores), ["row"])
    return _summed(back.withColumn("v", F.transform("v", lambda x: x * F.col("x"))), "col", width, F.col("v"))


def _summed(rows: DataFrame, key: str, width: int, v: Column) -> DataFrame:
    return rows.groupBy(key).agg(*[F.sum(v[j]).alias(f"v{j}") for j in range(width)]).select(key, F.array(*[f"v{j}" for j in range(width)]).alias("v"))


def leading_directions(rows: DataFrame, k: int, extra: int = 10, seed: int = 42, max_iter: int = 30, tol: float = 1e-9):
    """``rows`` (index, value) -> (table (col, v) of the leading right singular vectors, singular values, rounds).

    A random block of ``k + extra`` vectors, made from the column numbers by hash, is multiplied by rows' rows and made
    orthonormal until the k lengths change by less than ``tol``. Fewer vectors come back where the rank is lower. ``rows`` are
    read in every round, so they should be a written table.
    """
    rows = rows.select("index", "value")
    entries = rows.withColumn("row", F.monotonically_increasing_id()).select("row", F.explode(F.arrays_zip("index", "value")).alias("e"))
    columns = checkpointed(entries.where("e.value <> 0").select(F.col("e.index").alias("col")).distinct())
    count = columns.count()
    width = min(k + extra, count)
    if not width:
        return columns.select("col", F.array().cast("array<double>").alias("v")), np.zeros(0), 0
    sent = count * width <= SENT_NUMBERS
    if not sent:
        entries = checkpointed(entries.groupBy("row", F.col("e.index").alias("col")).agg(F.sum("e.value").alias("x")))
    noise = [F.xxhash64("col", F.lit(seed + j)) / F.lit(2.0**63) for j in range(width)]
    block = checkpointed(columns.select("col", F.array(*noise).alias("v")))
    turn, _size = _orthonormal(block, width)
    before = None
    for step in range(1, max_iter + 1):
        basis = _turned(block, turn)
        width = turn.shape[1]
        block = checkpointed(_pass_sent(rows, basis, width) if sent else _pass_joined(entries, checkpointed(basis), width))
        turn, size = _orthonormal(block, width)
        top = size[:k]
        if before is not None and len(before) == len(top) and np.all(np.abs(top - before) <= tol * top):
            break
        before = top
    return checkpointed(_turned(block, turn[:, :k])), np.sqrt(top), step
