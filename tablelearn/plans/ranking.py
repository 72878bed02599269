"""Global ranks, running totals and exact rank cuts without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .lineage import checkpointed


def running_total(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out`` = sum of ``value`` over all rows strictly before this one in ``order`` (a unique order).

    Rows are range-partitioned, so each task holds one slice; only the slice totals reach the driver.
    """
    sliced = df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    sliced = checkpointed(sliced)  # range bounds are sampled, so the slices must be fixed once
    totals = sliced.groupBy("_slice").agg(F.sum(value).alias("t")).orderBy("_slice").collect()
    offsets, before = [], 0
    for row in totals:
        offsets.append((row._slice, before))
        before += row.t
    if not offsets:
        return df.withColumn(out, F.lit(None))
    kind = dict(sliced.dtypes)[value]
    kind = "double" if kind in ("double", "float") else "long"
    table = df.sparkSession.createDataFrame(offsets, f"_slice int, _before {kind}")
    w = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(w), F.lit(0).cast(kind))
    return (
        sliced.withColumn("_inside", inside).join(F.broadcast(table), "_slice")  # one row per slice
        .withColumn(out, F.col("_inside") + F.col("_before")).drop("_slice", "_inside", "_before")
    )


def shuffle_key(id_col: str, seed: int) -> Column:
    """A repeatable pseudo-random sort key for a unique id."""
    return F.md5(F.concat(F.col(f"`{id_col}`").cast("string"), F.lit(f"-{seed}")))


def hash_cuts(keys: DataFrame, targets: dict, rows: int) -> dict:
    """For each group ``g`` and each 0-based rank in ``targets[g]``: the key at that rank.

    ``keys`` has columns g, k (hex text, unique). Ranks are located by counting rows per key prefix; only
    the rows of the boundary prefixes are sorted. Returns {g: [key or None when the rank is past the end]}.
    """
    spark = keys.sparkSession
    digits = 1
    while digits < 5 and 16**digits * 1000 < rows:
        digits += 1
    wanted = [(g, j, int(t)) for g, ts in targets.items() for j, t in enumerate(ts)]
    if not wanted:
        return {g: [] for g in targets}
    schema = keys.schema
    marks = spark.createDataFrame(
        wanted, f"g {schema['g'].dataType.simpleString()}, j int, t long"
    )
    w = Window.partitionBy("g").orderBy("p")  # at most 16**digits rows per group
    counted = (
        keys.groupBy("g", F.substring("k", 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(w))
    )
    hit = (
        counted.join(F.broadcast(marks), "g")  # marks: groups x cuts, both bounded by the caller
        .where((F.col("t") < F.col("upto")) & (F.col("t") >= F.col("upto") - F.col("n")))
        .select("g", "p", "j", (F.col("t") - F.col("upto") + F.col("n")).alias("r"))
    )
    edge = keys.withColumn("p", F.substring("k", 1, digits)).join(F.broadcast(hit.select("g", "p").distinct()), ["g", "p"])
    ranked = edge.withColumn("r", (F.row_number().over(Window.partitionBy("g", "p").orderBy("k")) - 1).cast("long"))
    found = {(r.g, r.j): r.k for r in ranked.join(F.broadcast(hit), ["g", "p", "r"]).select("g", "j", "k").collect()}
    return {g: [found.get((g, j)) for j in range(len(ts))] for g, ts in targets.items()}


def cut_number(key: Column, cuts: list) -> Column:
    """How many cuts lie at or below the key: the 0-based slice the key falls into."""
    present = [c for c in cuts if c is not None]
    out = F.lit(0)
    for c in present:
        out = out + F.when(key >= F.lit(c), 1).otherwise(0)
    return out
