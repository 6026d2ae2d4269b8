"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from stationspark.llm import (
    exact_dedup,
    exact_search,
    fingerprints,
    hard_negatives,
    jaccard_join,
    language_id,
    mixing,
    oracle,
    packing,
    secret_scan,
    substring_dedup,
    token_output,
    toxicity,
    vector_codes,
)
from stationspark.llm.shared import read_table, workers_can_import


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: declared language, source as host; the text model learns from pages too."""
    docs = language_id.from_documents(read_table(spark, sf_dir, "documents"))
    pages = language_id.from_pages(read_table(spark, sf_dir, "pages"))
    return language_id.identify(docs, docs.unionByName(pages)).withColumnRenamed("id", "doc_id")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: markup language, host and address suffix."""
    pages = language_id.from_pages(read_table(spark, sf_dir, "pages"))
    return language_id.identify(pages).withColumnRenamed("id", "page_id")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(read_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove(read_table(spark, sf_dir, "documents")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(read_table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(read_table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(read_table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_k(read_table(spark, sf_dir, "embeddings"))


QUERIES = (op1_language_id, language_id_pages, op2_fingerprints, op3_mixing, op4_substring_dedup, op5_exact_dedup, op6_toxicity, op7_token_planes, op8_packing,
           op9_jaccard_join, op10_secret_scan, op11_hard_negatives, op12_vector_codes, op13_exact_search)


def _ready(query: Callable) -> Callable:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_can_import(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _ready(q) for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.ORACLE)
