"""How many tasks a pass of a fit has."""

from pyspark.sql import functions as F

from tablelearn.operators.ensemble import _sigmoid
from tablelearn.operators.linear import LogisticRegression
from tablelearn.plans import lineage


def test_many_small_partitions_are_gathered(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1_000).repartition(cores * 2 + 30)
    assert lineage.for_passes(rows, 1_000).rdd.getNumPartitions() == 2 * cores
    assert lineage.for_passes(rows, (2 * cores + 9) * lineage.PASS_ROWS).rdd.getNumPartitions() == 2 * cores + 9
    few = spark.range(0, 1_000, 1, 1)
    assert lineage.for_passes(few, 1_000).rdd.getNumPartitions() == 1


def test_fits_of_many_passes_read_few_partitions(spark, monkeypatch):
    """All partitions of the last shuffle took part in every pass, and each sent a result to the driver."""
    from pyspark.ml.classification import LogisticRegression as MLLogistic

    seen, plain = [], MLLogistic.fit

    def fit(self, data, *more):
        seen.append(data.rdd.getNumPartitions())
        return plain(self, data, *more)

    monkeypatch.setattr(MLLogistic, "fit", fit)
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(400).select((F.col("id") % 17).cast("double").alias("s"), F.when(F.col("id") % 17 + F.col("id") % 5 > 9, 1.0).otherwise(0.0).alias("hit"))
    many = rows.repartition(2 * cores + 20).cache()
    assert LogisticRegression(["s"], "hit").fit(many).accuracy > 0.8
    _sigmoid(many, many.where("hit = 1").count(), many.where("hit = 0").count())
    many.unpersist()
    assert seen == [2 * cores, 2 * cores]
