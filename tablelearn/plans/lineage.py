"""Cut lineage in iterative jobs with tables written to the shared checkpoint folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the session names (``setCheckpointDir`` or ``spark.checkpoint.dir``). Only a local session without
    one gets a temporary folder; on a cluster an unset folder is an error."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tablelearn-checkpoint-")
        sc.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back. The new plan is a plain scan: it survives lost executors, prunes columns,
    and carries none of the inferred constraints that make the plans of long loops slow to optimise."""
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that one task of a pass may read, and tasks for each core below that.
PASS_ROWS = 500_000
PASS_TASKS = 2


def for_passes(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (``rows`` rows, cached or cheap) in few partitions, for fits of very many passes: a pass sends one result of
    every task to the driver, and a cached table keeps all partitions of its last shuffle however few rows they hold."""
    return df.coalesce(max(PASS_TASKS * df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / PASS_ROWS)))


def _own_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/tablelearn-{spark.sparkContext.applicationId}"


def drop_checkpoints(spark: SparkSession) -> None:
    """Delete the tables this application has written, once no result that reads them is needed any more."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
