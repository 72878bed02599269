"""Sum a fixed-length vector over all rows: one partial vector per task, added up by position in the JVM."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def lists_to_matrix(column) -> np.ndarray:
    """Arrow list<double> column of equal-length rows -> 2-d array."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def sum_vectors(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """``part`` maps an Arrow batch to a vector of ``size`` numbers; returns the total over all batches."""

    def partial(batches):
        total = np.zeros(size)
        seen = False
        for batch in batches:
            if batch.num_rows:
                total += part(batch)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["pos", "v"])

    out = np.zeros(size)
    for row in rows.mapInArrow(partial, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("v")).collect():
        out[row.pos] = row.v
    return out
