"""The corpus pipeline: documents to token windows, a stage for each operator.

Each stage takes what the one before kept, written as Parquet and read again,
and returns the columns of documents; the last one returns pieces of windows.

1. language ID: documents without an accepted language go.
2. exact dedup: of equal texts one stays.
3. n-gram Jaccard join: of each class of near copies the smallest id stays.
4. mixing: sources are brought to their targets; a document may be taken up
   to three times, or not at all.
5. packing: every document taken is cut into windows of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationspark.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from stationspark.llm.shared import read_table, stored, workers_can_import

#: A draw, a graph's components and a tokenizer are beyond SQL.
ORACLE_SQL = None


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_can_import(spark)
    return language_id.accepted_rows(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_can_import(spark)
    return jaccard_join.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_can_import(spark)
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_can_import(spark)
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_languages),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
