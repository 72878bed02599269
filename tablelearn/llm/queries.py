"""The package's queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from .bagminhash import near_duplicates
from .decontaminate import contamination, contamination_sql
from .fingerprint import fingerprints
from .hardneg import hard_negatives, hard_negatives_sql
from .hmm import score_texts
from .merkle import manifest, manifest_sql, tampered_leaf
from .metricjoin import similar_vectors
from .mixing import mix, mix_sql
from .packing import pack_documents
from .registry import query, read
from .sitetree import main_text
from .substring import remove_passages
from .toxicity import score_toxicity
from .urls import judge_sql, judge_urls


@query("op2_packing")
def op2_packing(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"))


@query("op5_urls", judge_sql())
def op5_urls(spark, sf_dir):
    return judge_urls(read(spark, sf_dir, "pages"))


@query("op9_vectors")
def op9_vectors(spark, sf_dir):
    return similar_vectors(read(spark, sf_dir, "embeddings"))


@query("op10_mixing", mix_sql())
def op10_mixing(spark, sf_dir):
    return mix(read(spark, sf_dir, "documents"))


@query("op1_substring")
def op1_substring(spark, sf_dir):
    return remove_passages(read(spark, sf_dir, "documents"))


@query("op3_bagminhash")
def op3_bagminhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


@query("op4_fingerprints")
def op4_fingerprints(spark, sf_dir):
    return fingerprints(read(spark, sf_dir, "documents"))


@query("op6_hmm")
def op6_hmm(spark, sf_dir):
    return score_texts(read(spark, sf_dir, "documents"))


@query("op7_sitetree")
def op7_sitetree(spark, sf_dir):
    return main_text(read(spark, sf_dir, "pages"))


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op11_merkle", manifest_sql())
def op11_merkle(spark, sf_dir):
    return manifest(read(spark, sf_dir, "documents"), claim=tampered_leaf())


@query("op12_decontamination", contamination_sql())
def op12_decontamination(spark, sf_dir):
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op13_hardneg", hard_negatives_sql())
def op13_hardneg(spark, sf_dir):
    return hard_negatives(read(spark, sf_dir, "embeddings"))
