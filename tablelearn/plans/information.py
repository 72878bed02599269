"""Mutual information from nearest neighbours, with sorted slices and running counts instead of trees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .lineage import checkpointed
from .neighbors import knn
from .ranking import running_total

#: Neighbouring values that one task holds at a time.
BLOCK_VALUES = 20_000


def digamma(x: Column) -> Column:
    """For x >= 1: eight steps of the recurrence, then the asymptotic series."""
    x = x.cast("double")
    y = x + 8.0
    steps = reduce(lambda a, b: a + b, [1.0 / (x + float(i)) for i in range(8)])
    z = 1.0 / (y * y)
    return F.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z / 252)) - steps


def digamma_sql(x: str) -> str:
    y = f"({x} + 8.0)"
    steps = " + ".join(f"1.0 / ({x} + {i}.0)" for i in range(8))
    return f"(ln({y}) - 0.5 / {y} - (1.0 / ({y} * {y})) * ({1 / 12!r} - (1.0 / ({y} * {y})) * ({1 / 120!r} - (1.0 / ({y} * {y})) / 252.0)) - ({steps}))"


def _reach(near: Column, own: Column, k: Column) -> Column:
    """(r, inside) of a value with ``own`` rows and other values ``near`` (d, w) by distance: the distance of the k-th other
    row, and the rows nearer than that, the value's own included. Copies of a value are at distance 0; enough of them
    make r = 0, and then they are the rows inside."""
    zero = F.struct(F.lit(0.0).alias("r"), own.alias("inside"), own.alias("met"))

    def step(a, e):  # ``met`` counts all rows so far, ``inside`` those before the present distance
        further = F.struct(e["d"].alias("r"), F.when(e["d"] > a["r"], a["met"]).otherwise(a["inside"]).alias("inside"), (a["met"] + e["w"]).alias("met"))
        return F.when(a["met"] > k, a).otherwise(further)

    return F.aggregate(near, zero, step)


def _class_reach(values: DataFrame, k: int) -> DataFrame:
    """``values`` (j, c, x, w, n: rows of the class) -> with r and inside: the distance to the k-th other row of the class.

    Values are numbered in order and cut into blocks; the k values on either side of a border go to both blocks.
    """
    numbered = running_total(values.withColumn("one", F.lit(1).cast("long")), ["j", "c", "x"], "one", "number").drop("one")
    block = lambda shift: F.floor((F.col("number") + shift) / BLOCK_VALUES)
    copied = numbered.withColumn("block", F.explode(F.sequence(block(-k), block(k))))
    order = Window.partitionBy("block").orderBy("number")
    near = []
    for i in range(1, k + 1):
        for side in (F.lag, F.lead):
            there = side(F.struct("j", "c", "x", "w"), i).over(order)
            same = (there["j"] == F.col("j")) & (there["c"] == F.col("c"))
            near.append(F.when(same, F.struct(F.abs(there["x"] - F.col("x")).alias("d"), there["w"].alias("w"))))
    held = copied.withColumn("near", F.array(*near)).where(F.col("block") == block(0))
    sorted_ = F.array_sort(F.filter("near", lambda e: e.isNotNull()))
    need = F.least(F.lit(k).cast("long"), F.col("n") - 1)
    return held.withColumn("reach", _reach(sorted_, F.col("w"), need)).select("j", "c", "x", "w", "n", "reach.r", "reach.inside")


def _rows_between(values: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    """``asked`` (j, key, x, r) -> (j, key, ``name``): rows of ``values`` (j, x, w) above x - r and below x + r, or equal to x
    for r = 0. Values and interval ends are sorted together once; an end's count is the running total at its place."""
    least, most = F.lit(0), F.lit(2)  # before or after the values equal to it
    ends = asked.select("j", "key", F.explode(F.array(
        F.struct((F.col("x") - F.col("r")).alias("v"), F.when(F.col("r") > 0, most).otherwise(least).alias("kind"), F.lit(-1).alias("sign")),
        F.struct((F.col("x") + F.col("r")).alias("v"), F.when(F.col("r") > 0, least).otherwise(most).alias("kind"), F.lit(1).alias("sign")),
    )).alias("e")).select("j", "key", "e.v", "e.kind", "e.sign", F.lit(0).cast("long").alias("w"))
    held = values.select("j", F.lit("").alias("key"), F.col("x").alias("v"), F.lit(1).alias("kind"), F.lit(0).alias("sign"), F.col("w").cast("long"))
    counted = running_total(held.unionByName(ends), ["j", "v", "kind", "key", "sign"], "w", "before").where("sign <> 0")
    return counted.groupBy("j", "key").agg(F.sum(F.col("sign") * F.col("before")).alias(name))


def with_class(cells: DataFrame, k: int = 3) -> list[float]:
    """Ross's estimate for each column: ``cells`` (j, c, x) has a row for each row and column, c the class as text.

    psi(n) + <psi(k)> - <psi(rows of the class)> - <psi(rows within the k-th neighbour of the class)>. Where copies make
    the distance zero, k counts the copies. Rows that are alone in their class are left out.
    """
    values = checkpointed(cells.groupBy("j", "c", "x").agg(F.count(F.lit(1)).alias("w")))
    sizes = values.groupBy("j", "c").agg(F.sum("w").alias("n")).where("n > 1")
    values = checkpointed(values.join(sizes, ["j", "c"]))
    asked = checkpointed(_class_reach(values, k).withColumn("key", F.concat("c", F.lit("|"), F.col("x").cast("string"))))
    whole = values.groupBy("j", "x").agg(F.sum("w").alias("w"))
    told = asked.join(_rows_between(whole, asked, "m"), ["j", "key"])
    return _estimates(told, digamma(F.col("inside")) - digamma(F.col("n")) - digamma(F.col("m")))


def _estimates(told: DataFrame, each: Column) -> list[float]:
    total = F.sum("w")
    found = told.groupBy("j").agg((digamma(total) + F.sum(F.col("w") * each) / total).alias("v")).collect()  # one row per column
    return {r.j: max(0.0, r.v) for r in found}


def with_number(pairs: DataFrame, k: int = 3) -> float:
    """The estimate of Kraskov and others for two numeric columns: ``pairs`` (x, y), on scales that can be compared.

    psi(n) + <psi(k)> - <psi(rows within r in x)> - <psi(rows within r in y)>, r the distance (the larger of both gaps) of
    the k-th neighbour. Copies count as in :func:`with_class`.
    """
    points = checkpointed(pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")))
    points = checkpointed(running_total(points.withColumn("one", F.lit(1).cast("long")), ["x", "y"], "one", "id").drop("one"))
    rows = points.select("id", F.array("x", "y").alias("x"))
    near = knn(rows, rows, k + 1, "chebyshev").where("query <> neighbor")
    lists = near.join(points.select(F.col("id").alias("neighbor"), "w"), "neighbor").groupBy(F.col("query").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("distance").alias("d"), "w"))).alias("near"))
    need = F.least(F.lit(k).cast("long"), F.lit(pairs.count() - 1).cast("long"))
    held = points.join(lists, "id", "left").withColumn("reach", _reach(F.coalesce("near", F.array().cast("array<struct<d:double,w:bigint>>")), F.col("w"), need))
    held = checkpointed(held.select("x", "y", "w", F.col("id").cast("string").alias("key"), "reach.r", "reach.inside"))
    told = held
    for name, at in (("m", "x"), ("l", "y")):
        whole = points.groupBy(F.col(at).alias("x")).agg(F.sum("w").alias("w")).withColumn("j", F.lit(0))
        asked = held.select(F.lit(0).alias("j"), "key", F.col(at).alias("x"), "r")
        told = told.join(_rows_between(whole, asked, name).drop("j"), "key")
    return _estimates(told.withColumn("j", F.lit(0)), digamma(F.col("inside")) - digamma(F.col("m")) - digamma(F.col("l"))).get(0, 0.0)
