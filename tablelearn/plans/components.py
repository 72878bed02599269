"""Connected components of an edge table by repeated min-hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .lineage import checkpointed
from .skew import hot_safe_join


FINISH_EDGES = 20_000


def components(edges: DataFrame, finish_edges: int = FINISH_EDGES) -> DataFrame:
    """``edges`` (a, b) of longs -> (node, comp) with comp = smallest node; nodes without edges are absent.

    Each round every node hooks to its smallest neighbour, parents are followed two steps, and the graph is
    contracted, so the edge table shrinks geometrically. Rounds are cut with written tables. Once at most
    ``finish_edges`` edges are left the remaining small graph is finished in one step.
    """
    current = _contract(edges.where(F.col("a") != F.col("b")))
    current = checkpointed(current)
    maps = []
    while True:
        size = current.count()
        if size == 0:
            break
        if size <= finish_edges:
            maps.append(_finish(current))
            break
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p"))
        parent = checkpointed(_jump(_jump(checkpointed(parent), size), size))
        maps.append(parent)
        left = hot_safe_join(current, parent.withColumnRenamed("p", "pa"), ["a"], rows=size)
        right = parent.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = hot_safe_join(left, right, ["b"], rows=size)
        moved = moved.where("pa != pb").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        current = checkpointed(_contract(moved))
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).limit(0)
    labels = maps[0].select(F.col("a").alias("node"), F.col("p").alias("comp"))
    for step in maps[1:]:
        labels = hot_safe_join(labels, step.select(F.col("a").alias("comp"), F.col("p")), ["comp"], "left")
        labels = labels.select("node", F.coalesce("p", "comp").alias("comp"))
    return checkpointed(labels)


def _finish(current):
    """Parents of a small graph (its size is checked by the caller)."""
    up = {}

    def root(v):
        while up.setdefault(v, v) != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    for row in current.collect():
        a, b = root(row.a), root(row.b)
        up[max(a, b)] = min(a, b)
    return current.sparkSession.createDataFrame([(v, root(v)) for v in list(up)], "a long, p long")


def _contract(edges):
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _jump(parent, size):
    """Follow one more parent link."""
    up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
    return hot_safe_join(parent, up, ["p"], "left", rows=size).select("a", F.coalesce("q", "p").alias("p"))
