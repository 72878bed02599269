"""Least-squares monotone fit of any number of points: neighbours that fall are pooled inside slices, and slices move."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .lineage import checkpointed
from .skew import hot_safe_join

#: Pools of a slice, which one task holds.
SLICE_POOLS = 50_000
#: Pools of a piece of a curve, which one row holds.
PIECE_POOLS = 256


def pool_adjacent(weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First point, weight and total of each pool once no pool's mean lies above the next one's."""
    first, weights, totals = [], [], []
    for i, (w, t) in enumerate(zip(weight.tolist(), total.tolist())):
        at = i
        while first and totals[-1] * w > t * weights[-1]:
            at, w, t = first.pop(), w + weights.pop(), t + totals.pop()
        first.append(at)
        weights.append(w)
        totals.append(t)
    return np.array(first, dtype=np.int64), np.array(weights), np.array(totals)


def _pooled(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("lo")
    first, w, t = pool_adjacent(part["w"].to_numpy(), part["t"].to_numpy())
    last = np.append(first[1:], len(part)) - 1
    return pd.DataFrame({
        "slice": np.int64(key[0]), "place": np.arange(len(first)), "lo": part["lo"].to_numpy()[first], "hi": part["hi"].to_numpy()[last], "w": w, "t": t,
    })


def monotone_pools(points: DataFrame, slice_pools: int = SLICE_POOLS) -> DataFrame:
    """``points`` (x, w, t: weight and weighted sum) -> (number, lo, hi, w, t), the pools of the rising fit in order.

    Pooling inside a slice never joins points that the whole fit keeps apart, so slices are pooled by themselves. The fit
    is done when no last pool of a slice lies above the first pool of the next. Otherwise the pools are cut into slices
    anew, half a slice further on, which brings every border into the middle of a slice: at least one pair is pooled in
    each round. Only one row per slice is compared across slices.
    """
    start = points.groupBy("x").agg(F.sum("w").cast("double").alias("w"), F.sum("t").cast("double").alias("t"))
    start = checkpointed(start.where("w > 0").select(F.col("x").alias("lo"), F.col("x").alias("hi"), "w", "t"))
    slices = max(1, math.ceil(start.count() / slice_pools))
    pools = checkpointed(start.repartitionByRange(slices, "lo").withColumn("slice", F.spark_partition_id().cast("long")))
    shift = 0
    while True:
        pools = checkpointed(pools.groupBy("slice").applyInPandas(_pooled, "slice long, place long, lo double, hi double, w double, t double"))
        ends = pools.groupBy("slice").agg(
            F.count(F.lit(1)).alias("n"), F.min_by(F.struct("w", "t"), "place").alias("head"), F.max_by(F.struct("w", "t"), "place").alias("tail")
        )
        order = Window.orderBy("slice")  # one row per slice
        before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
        falls = F.lag("tail.t").over(order) * F.col("head.w") > F.col("head.t") * F.lag("tail.w").over(order)
        ends = checkpointed(ends.select("slice", F.coalesce(before, F.lit(0)).alias("before"), F.coalesce(falls, F.lit(False)).alias("falls")))
        numbered = pools.join(ends, "slice").withColumn("number", F.col("before") + F.col("place"))
        if not ends.agg(F.max("falls")).first()[0]:
            return checkpointed(numbered.select("number", "lo", "hi", "w", "t"))
        shift = slice_pools // 2 - shift
        pools = numbered.select(F.floor((F.col("number") + shift) / slice_pools).alias("slice"), "lo", "hi", "w", "t")


def curve_pieces(pools: DataFrame, piece_pools: int = PIECE_POOLS) -> DataFrame:
    """(piece, x, y): corners of the fitted curve in order; a piece ends with the first corner of the next one."""
    mean = F.col("t") / F.col("w")
    corners = pools.select(F.floor(F.col("number") / piece_pools).alias("piece"), F.explode(F.array(F.struct(F.col("lo").alias("x"), mean.alias("y")), F.struct(F.col("hi").alias("x"), mean.alias("y")))).alias("c"))
    first = pools.where(f"number % {piece_pools} = 0 AND number > 0")
    first = first.select(F.floor(F.col("number") / piece_pools - 1).alias("piece"), F.struct(F.col("lo").alias("x"), mean.alias("y")).alias("c"))
    c = F.sort_array(F.collect_set("c"))
    return corners.unionByName(first).groupBy("piece").agg(c.alias("c")).select("piece", F.col("c.x").alias("x"), F.col("c.y").alias("y"))


def interpolated(df: DataFrame, score: str, pieces: DataFrame, out: str) -> DataFrame:
    """Add ``out``: the curve of :func:`curve_pieces` at ``score``, straight between corners, level outside.

    A row meets one piece, found by the pieces' first corners; the piece is joined by its number, so neither side is held
    whole anywhere.
    """
    starts = np.array([r.x for r in pieces.select("piece", F.col("x")[0].alias("x")).orderBy("piece").collect()])  # one number per piece

    @F.pandas_udf("long")
    def piece(s: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(starts, s.to_numpy(dtype=float), side="right") - 1, 0))

    told = df.withColumn("_piece", piece(F.col(score)))
    joined = hot_safe_join(told, pieces.select(F.col("piece").alias("_piece"), F.col("x").alias("_x"), F.col("y").alias("_y")), ["_piece"], "left")
    s, below = F.col(score), F.size(F.filter("_x", lambda v: v <= F.col(score)))
    x0, x1, y0, y1 = F.get("_x", below - 1), F.get("_x", below), F.get("_y", below - 1), F.get("_y", below)
    value = F.when(below == 0, F.get("_y", F.lit(0))).when(x1.isNull(), y0).otherwise(y0 + (y1 - y0) * (s - x0) / (x1 - x0))
    return joined.withColumn(out, value).drop("_piece", "_x", "_y")
