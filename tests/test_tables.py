"""How many rows one task reads of a table."""

from tablelearn.sources import tables


def test_splits_of_too_many_rows_are_dealt_out(spark, tmp_path, monkeypatch):
    """Files of few bytes and many rows gave one task of a tree fit a whole split, however many rows it held."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(10_000).repartition(cores * 2).write.parquet(f"{tmp_path}/t.parquet")
    scan = tables.table(spark, str(tmp_path), "t")
    monkeypatch.setattr(tables, "SPLIT_ROWS", 10_000 // (cores * 5))
    dealt = tables.spread(scan)
    assert dealt.rdd.getNumPartitions() >= 5 * cores
    assert sorted(r.id for r in dealt.collect()) == list(range(10_000))


def test_rows_of_a_task_stay_few_at_the_given_limit(spark, tmp_path):
    rows = spark.sparkContext.defaultParallelism * 400_000
    spark.range(rows).write.parquet(f"{tmp_path}/t.parquet")
    dealt = tables.spread(tables.table(spark, str(tmp_path), "t"))
    assert rows / dealt.rdd.getNumPartitions() <= 300_000
