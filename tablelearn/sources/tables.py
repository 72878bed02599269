"""Parquet tables of one folder."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

#: Rows of a split, on average, that one task may have to read again and again from a cache.
SPLIT_ROWS = 300_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan over all cores when the files give fewer splits than there are cores, ahead of
    CPU-heavy row work, and over more splits when these hold more than ``SPLIT_ROWS`` rows each: compressed files give
    splits of a fixed size in bytes, whose rows may be many. Otherwise the scan is left alone, without a shuffle."""
    splits, wanted = scan.rdd.getNumPartitions(), scan.sparkSession.sparkContext.defaultParallelism
    rows = scan.count()  # from the footers
    wanted = max(wanted, math.ceil(rows / SPLIT_ROWS))
    return scan if splits >= wanted else scan.repartition(wanted)
