import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablelearn.llm import bagminhash, mixing, packing, substring, toxicity
from tablelearn.llm.all import ORACLES, QUERIES

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def test_all_queries_are_there():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{k}" for k in range(1, 14))}
    assert set(ORACLES) == {"op5_urls", "op10_mixing", "op11_merkle", "op12_decontamination", "op13_hardneg"}


def test_stages_act_on_what_their_predecessor_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        before, after = [r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()]
        if name == "toxicity":
            rejected = {r["doc_id"] for r in toxicity.score_toxicity(docs, labels).where("predicted = 1").collect()}
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - rejected
        if name == "near_dedup":
            assert {r["doc_id"] for r in after} == {r["class_id"] for r in bagminhash.near_duplicates(docs).collect()}
        if name == "substring_dedup":
            want = {r["doc_id"]: r["text"] for r in substring.remove_passages(docs).collect()}
            assert {r["doc_id"]: r["text"] for r in after} == want and all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "source_mix":
            want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
            assert Counter(r["doc_id"] for r in after) == want
        if name == "packing":
            assert sum(r["length"] for r in after) == sum(r["doc_tokens"] for r in packing.cut(docs).where("start = 0").collect())
        else:
            assert out.columns == columns
        docs = out


def test_run(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert packed.count() > 0 and packed.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


def awkward(spark):
    rows = [(1, "one two three four five six", "en", "a", 27), (1, "one two three four five six", "en", "a", 27), (2, None, None, None, None),
            (None, "no id but a text of several words here", "en", "b", None), (3, "", "de", "a", 0), (4, "w " * 20_000, "fr", "c", 40_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING:
        frame = frame.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return frame


#: Names that the operators use inside.
CLASHING = ["row", "row_key", "sig", "digest", "spans", "begins", "cut", "_span_key", "_near_key", "d1", "_mix_id", "_mix_size", "size", "id", "of", "copies", "nth", "score", "node", "a.b"]


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_awkward_rows(spark, empty):
    docs = awkward(spark).limit(0) if empty else awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert (len(rows) == 0) == empty, name
        if name != "packing":
            assert out.columns == docs.columns, name
            assert all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in CLASHING), name
        docs = spark.createDataFrame(rows, out.schema)
