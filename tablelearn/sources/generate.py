"""Synthetic regression and classification tables, generated where they are needed, any number of rows.

Numbers come from md5 of (row id, column, seed): the same row has the same values on any cluster layout. The sum of
twelve uniform draws, centred, stands in for a standard normal value.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NOISE = 10.0
HEX_DIGITS = 2
DRAWS = 12


def _uniform(digest: Column, i: int) -> Column:
    """The i-th byte of a hex digest as a number in (0, 1)."""
    part = F.conv(F.substring(digest, 1 + HEX_DIGITS * i, HEX_DIGITS), 16, 10).cast("double")
    return (part + 0.5) / 256.0


def normal(key: Column, label: str) -> Column:
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"-{label}")))
    parts = [_uniform(digest, i) for i in range(DRAWS)]
    return sum(parts[1:], parts[0]) - DRAWS / 2


def _features(ids: DataFrame, id_col: str, n_features: int, seed: int) -> DataFrame:
    return ids.select(F.col(id_col).alias("id"), *[normal(F.col(id_col), f"x{i}-{seed}").alias(f"feature_{i}") for i in range(n_features)])


def regression_weights(n_features: int, seed: int) -> list[float]:
    rng = random.Random(seed)
    return [round(rng.uniform(0, 100), 6) for _ in range(n_features)]


def make_regression(
    spark: SparkSession, n_samples=100, n_features=4, seed=42, noise=NOISE, include_target=True, output="rows",
    ids: DataFrame | None = None, id_col="id", weights=None,
) -> DataFrame:
    """feature_i ~ normal, target = weights . features + noise * normal. ``ids`` generates one row per given key."""
    ids = spark.range(n_samples) if ids is None else ids
    weights = weights or regression_weights(n_features, seed)
    rows = _features(ids, id_col, n_features, seed)
    if include_target:
        target = sum((F.col(f"feature_{i}") * F.lit(w) for i, w in enumerate(weights)), F.lit(0.0))
        target = target + F.lit(float(noise)) * normal(F.col("id"), f"noise-{seed}")
        rows = rows.withColumn("target", target).withColumn("target_numeric", F.col("target"))
    return _shaped(rows, n_features, include_target, output)


def make_classification(
    spark: SparkSession, n_samples=100, n_features=4, seed=42, include_target=True, output="rows",
    ids: DataFrame | None = None, id_col="id",
) -> DataFrame:
    """Two classes; class c has its centre at +1 or -1 in every column (sign alternating by column)."""
    ids = spark.range(n_samples) if ids is None else ids
    rows = _features(ids, id_col, n_features, seed)
    digest = F.md5(F.concat(F.col("id").cast("string"), F.lit(f"-class-{seed}")))
    rows = rows.withColumn("target", F.when(F.substring(digest, 1, 1) >= "8", 1).otherwise(0))
    side = F.when(F.col("target") == 1, 1.0).otherwise(-1.0)
    moved = [(F.col(f"feature_{i}") + side * (1.0 if i % 2 == 0 else -1.0)).alias(f"feature_{i}") for i in range(n_features)]
    rows = rows.select("id", *moved, *(["target", F.col("target").cast("double").alias("target_numeric")] if include_target else []))
    return _shaped(rows, n_features, include_target, output)


def _shaped(rows, n_features, include_target, output):
    if output == "rows":
        return rows
    if output != "arrays":
        raise ValueError("output must be rows or arrays")
    return pack_arrays(rows, "id", [f"feature_{i}" for i in range(n_features)], "target" if include_target else None)


PACK_ROWS = 1_000


def pack_arrays(rows: DataFrame, id_col: str, cols: list[str], target: str | None = None, group: str | None = None, pack_rows=PACK_ROWS) -> DataFrame:
    """Rows packed as arrays: (group, chunk, ids, features, target), in id order inside a chunk.

    A chunk holds the ids of one range of ``pack_rows`` consecutive values, so no group is collected whole.
    """
    part = [F.col(group).alias("group")] if group else []
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    item = F.struct(F.col(id_col).alias("id"), x.alias("x"), *([F.col(target).alias("y")] if target else []))
    chunk = F.floor(F.col(id_col) / F.lit(pack_rows)).cast("long").alias("chunk")
    packed = rows.groupBy(*part, chunk).agg(F.sort_array(F.collect_list(item)).alias("items"))
    out = [F.col("items.id").alias("ids"), F.col("items.x").alias("features")]
    out += [F.col("items.y").alias("target")] if target else []
    return packed.select(*(["group"] if group else []), "chunk", *out, F.size("items").cast("long").alias("n_samples"))
