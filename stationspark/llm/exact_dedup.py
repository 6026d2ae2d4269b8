"""Exact duplicates through an extendible-hash index on shared files.

Texts are equal when identical after deleting white space.  The key of a text
is the 64-bit hash of what is left.

1. ``key_table``: one narrow row per document (id, length, hash, digest),
   written once; the text itself is not in it.
2. ``directory``: the leading bits of the hash address the directory.  Its
   depth doubles the number of cells until an average bucket has a quarter
   of the capacity; a bucket whose bytes exceed the capacity is split by one
   more bit, again and again, down to the directory's full depth.  The
   directory has at most ``2 ** MAX_DEPTH`` cells, so it is small enough to
   broadcast at any size of the input; past that, buckets grow instead and
   spill.  A bucket that is overfull with copies of one text cannot be split:
   copies meet in a partial aggregation before the shuffle.
3. ``build_index``: documents are grouped by bucket, hash and the text's
   bytes.  Different texts of one hash form a chain.  Entries are written in
   ranges of the key, a range for each owner task.
4. ``lookup``: every document finds its entry by hash and digest.  A text
   with very many copies makes one side of this join uneven; Spark splits
   such partitions.

Defined results: a null text counts as empty, and all empty or blank texts
are one group; of equal texts the one with the most code points stays, then
the smallest id (a null id loses against any other); a repeated row (same id
and text) counts in ``group_size`` and shares the mark of its twin, and
``survivors`` keeps one of them.  An empty table gives no rows.  Extra
columns are ignored by the index and kept by ``survivors``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationspark.llm.shared import SPACE_CHARS, free_names, stored, whole_text

#: Bytes that a bucket may hold before it is split.
CAPACITY = 64 << 20
#: Bits of the hash that the directory can use.
MAX_DEPTH = 16


def _bare_text():
    """The text without white space."""
    return F.translate(whole_text(), SPACE_CHARS, "")


def key_table(docs: DataFrame) -> DataFrame:
    bare = docs.select("doc_id", F.length(whole_text()).alias("n"), _bare_text().alias("bare"))
    return stored(bare.select("doc_id", "n", F.octet_length("bare").cast("long").alias("bytes"),
                              F.xxhash64("bare").alias("h"), F.sha2("bare", 256).alias("text_sha256")),
                  "exact-keys")


def _cell(hash_column, depth: int):
    """The leading ``depth`` bits as a number from 0."""
    return F.shiftrightunsigned(hash_column, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """``(cell, depth, bucket)`` for every cell of the directory, and its depth.

    ``depth`` is the number of bits by which the cell's bucket is known;
    ``bucket`` is the smallest cell that shares it.
    """
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    full = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, total / capacity)))) + 2)
    cells = keys.groupBy(_cell(F.col("h"), full).alias("cell")).agg(F.sum("bytes").alias("bytes"))
    levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(0), F.lit(full))).alias("depth"))
    unknown = F.lit(full) - F.col("depth")
    prefix = F.call_function("shiftright", F.col("cell"), unknown)
    fits = (levels.withColumn("prefix", prefix).groupBy("depth", "prefix")
            .agg(F.sum("bytes").alias("held"))
            .filter((F.col("held") <= capacity) | (F.col("depth") == full)))
    found = (levels.select("cell", "depth", prefix.alias("prefix"))
             .join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth")))
    low = F.call_function("shiftleft", prefix, unknown)
    return stored(found.select("cell", "depth", low.alias("bucket")), "exact-directory"), full


def build_index(docs: DataFrame, keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One entry per distinct text: bucket, hash, place in the chain, digest,
    the row that stays and the number of rows."""
    cells, full = directory(keys, capacity)
    rows = docs.select("doc_id", F.length(whole_text()).alias("n"), _bare_text().alias("bare"))
    rows = rows.withColumn("h", F.xxhash64("bare")).withColumn("cell", _cell(F.col("h"), full))
    entries = (rows.join(F.broadcast(cells), "cell")
               .groupBy("bucket", "depth", "h", "bare")
               .agg(F.max(F.struct("n", F.bitwise_not("doc_id").alias("id"))).alias("best"),
                    F.count(F.lit(1)).alias("group_size")))
    entries = entries.select("bucket", "depth", "h", F.sha2("bare", 256).alias("text_sha256"),
                             F.bitwise_not("best.id").alias("keep_id"), "group_size")
    chain = Window.partitionBy("bucket", "h").orderBy("text_sha256")
    entries = entries.withColumn("chain", F.row_number().over(chain))
    return stored(entries.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h", "chain"),
                  "exact-index")


def lookup(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Every document with its entry of the index."""
    return keys.join(index, ["h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "bucket", "depth", "chain", "h")


def find(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    keys = key_table(docs)
    return lookup(keys, build_index(docs, keys, capacity))


def survivors(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, with all their columns."""
    own_id, own_key, key = free_names(docs, "__id", "__h", "__key")
    kept = find(docs, capacity).filter("kept").select("doc_id", "h").dropDuplicates()
    kept = kept.select(F.col("doc_id").alias(own_id), F.col("h").alias(own_key))
    keyed = docs.withColumn(key, F.xxhash64(_bare_text()))
    stay = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept[own_id]) & (keyed[key] == kept[own_key]), "left_semi")
    return stay.dropDuplicates(["doc_id", key]).select(*[stay[c] for c in docs.columns])
