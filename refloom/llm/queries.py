"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.llm import (
    covering, decontaminate, extraction, fingerprints, langid, language_model, merkle, neardup, packing, secrets, sql, token_counts, toxicity,
    vector_codes,
)
from refloom.llm.common import remainder
from refloom.session import Tables

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(Tables(spark, sf_dir).documents)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of each document: a replacement in the middle, an insertion in the first half, a deletion at the end."""
    docs = Tables(spark, sf_dir).documents
    n = F.coalesce(F.length("text"), F.lit(0))

    def change(start, delete, insert):
        return F.struct(start.cast("int").alias("start"), F.lit(delete).alias("delete"), insert.alias("insert"))

    edits = F.array(
        change(F.floor(n / 2), 7, F.lit(" Edited passage; it's new.")),
        change(F.floor(n / 4), 0, F.upper(F.substring("text", 1, 12))),
        change(n, 3, F.lit("")),
    )
    return token_counts.edited_counts(docs, edits, RANKS, public_tokenizers.PATTERN)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(Tables(spark, sf_dir).documents, VOCABULARY)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return toxicity.toxicity(t.documents, t.labels)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(Tables(spark, sf_dir).documents)


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(Tables(spark, sf_dir).documents)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return decontaminate.leaks(t.documents, t.benchmark)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(Tables(spark, sf_dir).documents, words=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(Tables(spark, sf_dir).pages)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(Tables(spark, sf_dir).documents)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other row (by its id's checksum) is verified without the line breaks of its text."""
    docs = Tables(spark, sf_dir).documents
    text = F.when(remainder(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(docs, now={"text": text})


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(Tables(spark, sf_dir).embeddings)


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering.near_duplicates(Tables(spark, sf_dir).documents)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_secret_scans": op6_secret_scans,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_fingerprints": op10_fingerprints,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_vector_codes": op12_vector_codes,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}
ORACLE: dict[str, str] = {"op11_merkle_manifest": sql.MERKLE, "op12_vector_codes": sql.CODES}
