"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SMALL_ROWS = 1_000_000
HOT_SHARE = 1_000


def hot_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join where ``right`` has at most one row per key and ``left`` may be skewed.

    Keys holding more than 1/HOT_SHARE of the left rows (fewer than HOT_SHARE of them by counting) are joined by
    broadcasting just their right rows, so their left rows never move; all other keys join by shuffle.
    """
    total = left.count() if rows is None else rows
    if total <= SMALL_ROWS:
        return left.join(right, on, how)
    # a null key finds no partner, so its rows need not meet in one partition
    empty = F.greatest(*[F.col(f"`{c}`").isNull() for c in on], F.lit(False))
    alone, left = left.where(empty), left.where(~empty)
    joined = _hot_safe(left, right, on, how, total)
    return joined.unionByName(alone, allowMissingColumns=True) if how == "left" else joined


def _hot_safe(left, right, on, how, total):
    counts = left.groupBy(*on).count().where(F.col("count") > total / HOT_SHARE).select(*on)
    hot = counts.collect()
    if not hot:
        return left.join(right, on, how)
    keys = F.broadcast(left.sparkSession.createDataFrame(hot, counts.schema))
    few = left.join(keys, on, "left_semi").join(F.broadcast(right.join(keys, on, "left_semi")), on, how)
    return few.unionByName(left.join(keys, on, "left_anti").join(right, on, how))
