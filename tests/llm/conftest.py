import random

import pytest
from pyspark.sql import functions as F

from stationspark.llm.shared import workers_can_import

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_can_import(spark)


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest data set, as Spark and pandas frames."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return docs, docs.toPandas().sort_values("doc_id").reset_index(drop=True)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(words))


# names that the operators use inside, and names of their results
CLASHING = ("size", "h", "th", "n", "bucket", "block", "node", "root", "copies", "start", "score", "toxic", "id", "host",
            "of", "key", "n_words", "keep_id", "target", "shard", "tree")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated
    rows and extra columns with clashing names."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 200), "en", "a"), (2, prose(2, 200), "en", "a"), (3, prose(2, 200) + " end", "en", None),
        (4, None, None, None), (5, "", "en", "b"), (6, " \n\t ", "en", "b"), (7, long, "en", "c"), (8, long, "de", "c"),
        (9, "one two", "de", "c"), (9, "one two", "de", "c"), (9, "other words here", "de", "c"),
        (None, prose(3, 120), "en", "a"), (None, None, None, None), (10, prose(3, 120), "EN-us", "a"),
        (11, "日本 語   é 😀 " * 30, "ja", "d"), (12, "x" * 5000, "en", "d"), (13, "12345 67890 !!! ###", "en", "d"),
        (14, prose(2, 100) + " " + prose(9, 100), "en", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit("x") for c in CLASHING})
