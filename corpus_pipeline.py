"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablelearn.llm.bagminhash import drop_near_duplicates
from tablelearn.llm.mixing import mix_documents
from tablelearn.llm.packing import pack_documents
from tablelearn.llm.substring import drop_passages
from tablelearn.llm.toxicity import drop_toxic
from tablelearn.plans.lineage import checkpoint_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds; ``n_chars`` follows the text."""
    kept = drop_passages(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in kept.columns else kept


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("source_mix", source_mix), ("packing", packing),
]

#: The classifier, the signatures and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage returns is written to the shared checkpoint folder."""
    folder = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
