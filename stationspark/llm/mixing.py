"""Mixing sources to target weights by a multivariate-hypergeometric tree.

1. ``source_targets``: the words of each source and its target.  Sources
   share all words by weight; a target stops at ``MOST`` times the source's
   words and the rest is shared by the others.  With the sources in order of
   the level at which they are full, the common level is found by prefix
   sums.  This table has a row for each source, not for each document.
2. ``permuted``: every source's documents in hashed order, each with the
   words before it.  The order is dealt to buckets by hash, so a source with
   a third of all rows is many groups; the words of the buckets before are
   added to the place inside a bucket.
3. ``drawn``: a source whose target is r times its words and a rest takes all
   its documents r times and, once more, those that lie before the rest in
   the permuted order.  The document that crosses the rest is set aside, and
   the gap before it is filled with those behind it, in the same order:
   ``gap_fills`` goes on with those of at most ``1 / PARTS`` of the gap, again
   up to the one that crosses it, until none is so small; a round that one
   crosses leaves less than that share of the gap.  Where they are too few,
   documents are taken again, up to ``MOST`` times.  Then the largest
   documents that fit follow one by one, fewer than ``PARTS``, and one that
   may go over the target if that comes nearer to it.
   The words of a source in this order, repeats after each other, form blocks
   of ``BLOCK_WORDS``.
4. ``splitting_tree``: the blocks of all sources are dealt to output shards.
   A node of the tree has a quota of blocks of each source and a range of
   shards; how many of each source go to its left half is a draw of the
   multivariate hypergeometric law with the exact number of blocks that the
   left half holds.  Nodes of a level are split in parallel; each draw is
   seeded by its node, so reruns agree.  Blocks without a row are not kept:
   there are never more rows than blocks.
5. ``mix``: a shard takes the next blocks of each source's permuted order,
   disjoint from all other shards' blocks, and is shuffled by itself.

Defined results: a null text has no words; a null source is a source, the
last one; a source without words has target 0 and its documents are taken 0
words; rows are known by a hash of id, text and source (``key``), those alike
in all three by their place among them, so rows with one id or none are spread
like any others; an empty table gives no rows; extra columns are kept by ``mix``
and ignored elsewhere.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationspark.llm.shared import WORD, free_names, stored, whole_text

#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: Times that a source, and a document, is taken at most.
MOST = 3
SEED = 20_240_517
BLOCK_WORDS = 16_384
SHARD_BLOCKS = 64
#: Rows of all sources to one bucket of the permuted order.
BUCKET_ROWS = 20_000
#: Documents that fill a gap at once are at most this part of it.
PARTS = 8
#: Rows up to which the table of sources is broadcast.
MOST_BROADCAST = 100_000


def _key() -> Column:
    return F.xxhash64("doc_id", whole_text(), F.col("source").cast("string"))


def _occurrence(key: str, text_hash: Column) -> Column:
    """Tells rows with one key apart."""
    return F.row_number().over(Window.partitionBy(key).orderBy("doc_id", "source", text_hash))


def word_counts(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(whole_text()).alias("h"),
                       _key().alias("key"), F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"))
    return stored(rows.withColumn("occurrence", _occurrence("key", F.col("h"))).drop("h"), "mix-sizes")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_no, source_size, target)``, a row for each source."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("source_no", F.lit(len(weights))) + 1)
    rows = rows.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    rows = rows.withColumn("full_at", F.col("cap") / F.col("weight"))
    every, order = Window.partitionBy(), Window.orderBy("full_at", "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level of those not yet full, if all before this one are
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(onwards))
    rows = rows.withColumn("level", level)
    # right for the first that is not full then; later ones give lower levels
    rows = rows.withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every))
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return stored(rows.select("source", "source_no", "source_size", target.alias("target")), "mix-sources")


def _side(df: DataFrame, sources: DataFrame) -> DataFrame:
    """A table of a few rows for each source, broadcast if there are not too
    many sources; otherwise Spark splits the rows of large ones."""
    return F.broadcast(df) if sources.count() <= MOST_BROADCAST else df


def _words_before(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the words before each in its source's permuted order."""
    inside = Window.partitionBy("source_no", "bucket").orderBy("turn", "key", "occurrence")
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("source_no", "bucket", (F.sum("words").over(
        Window.partitionBy("source_no").orderBy("bucket")) - F.col("words")).alias("before"))
    rows = rows.withColumn("place", F.sum("size").over(inside) - F.col("size"))
    rows = rows.join(before, ["source_no", "bucket"])
    return rows.withColumn(name, F.col("before") + F.col("place")).drop("before", "place")


def permuted(sizes: DataFrame, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """Every document with ``start``, the words before it in its source."""
    n = sizes.count()
    buckets = max(1, math.ceil(n / BUCKET_ROWS))
    rows = sizes.join(_side(sources, sources), sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    rows = rows.withColumn("turn", F.xxhash64("key", "occurrence", F.lit(seed)))
    rows = rows.withColumn("bucket", F.pmod("turn", F.lit(buckets)))
    return stored(_words_before(rows, "start"), "mix-order")


def gap_fills(free: DataFrame, gaps: DataFrame, sources: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``(source_no, start, size, at)`` of the free documents that fill the
    gap before the rest, ``at`` their place; and the gaps that are left."""
    fills, free = [], free.select("source_no", "bucket", "turn", "key", "occurrence", "start", "size")
    while True:
        small = free.join(_side(gaps, sources), "source_no").filter(PARTS * F.col("size") <= F.col("gap"))
        small = _words_before(small, "ahead")
        fits = F.col("ahead") + F.col("size") <= F.col("gap")
        small = stored(small.withColumn("fits", fits).withColumn("at", F.col("rest") - F.col("gap") + F.col("ahead"))
                       .drop("rest", "gap", "ahead"), "mix-fill")
        if small.isEmpty():
            return fills, gaps
        fills.append(small.filter("fits").select("source_no", "start", "size", "at"))
        gaps = stored(_closed(gaps, fills[-1]), "mix-gaps")
        # those set aside are larger than a part of what is left
        free = small.filter("not fits").drop("fits", "at")


def _closed(gaps: DataFrame, fills: DataFrame) -> DataFrame:
    got = fills.groupBy("source_no").agg(F.sum("size").alias("got"))
    return gaps.join(got, "source_no", "left").select(
        "source_no", "rest", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap"))


def drawn(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Every document with the number of times it is taken (``copies``), and
    the places (``ats``) of those that fill a gap."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("whole", F.least(whole, F.lit(MOST)))
    rows = rows.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = rows.withColumn("more", (F.col("whole") < MOST) & (F.col("start") + F.col("size") <= F.col("rest")))
    left = F.max("rest") - F.coalesce(F.sum(F.when(F.col("more"), F.col("size"))), F.lit(0))
    gaps = stored(rows.groupBy("source_no").agg(F.max("rest").alias("rest"), left.alias("gap")), "mix-gaps")
    fills = []
    for k in range(1, MOST + 1):
        # first those behind the rest, then any document once more
        free = rows.filter((F.col("whole") + k <= MOST) & (F.col("size") > 0) & (F.lit(k > 1) | ~F.col("more")))
        some, gaps = gap_fills(free, gaps, sources)
        fills += some
    last = False
    while True:
        # the last one may go over, if that comes nearer
        fits = F.col("size") < 2 * F.col("gap") if last else F.col("size") <= F.col("gap")
        free = rows.filter(F.col("size") > 0).drop("rest").join(_side(gaps, sources), "source_no").filter(fits)
        extra = F.lit(0)
        if fills:
            free = free.join(_together(fills).groupBy("source_no", "start").agg(F.count(F.lit(1)).alias("extra")),
                             ["source_no", "start"], "left")
            extra = F.coalesce("extra", F.lit(0))
        free = free.filter(F.col("whole") + F.col("more").cast("long") + extra < MOST)
        off = F.abs(F.col("gap") - F.col("size"))
        best = stored(free.groupBy("source_no").agg(F.min(F.struct(off.alias("off"), "start", "size", (
            F.col("rest") - F.col("gap")).alias("at"))).alias("best")).select(
            "source_no", "best.start", "best.size", "best.at"), "mix-best")
        fills.append(best)
        if last:
            break
        last = best.isEmpty()
        gaps = stored(_closed(gaps, best), "mix-gaps")
    ats = _together(fills).groupBy("source_no", "start", "size").agg(F.sort_array(F.collect_list("at")).alias("ats"))
    rows = rows.join(ats, ["source_no", "start", "size"], "left")
    return rows.withColumn("copies", F.col("whole") + F.col("more").cast("long") + F.coalesce(F.size("ats"), F.lit(0)))


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def draws(rows: DataFrame) -> DataFrame:
    """A row for each time that a document is taken, with its block."""
    taken = rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    # the last, partial round ends where its rest ends; gaps are filled there
    fill = F.col("copy") - F.col("whole") - F.col("more").cast("long")
    inside = F.least(F.when(fill >= 0, F.get("ats", fill.cast("int"))).otherwise(F.col("start")),
                     F.greatest(F.floor("rest") - 1, F.lit(0)))
    place = F.when(F.col("copy") < F.col("whole"), F.col("copy") * F.col("source_size") + F.col("start")).otherwise(
        F.col("whole") * F.col("source_size") + inside)
    return taken.withColumn("block", F.floor(place / BLOCK_WORDS))


def splitting_tree(quotas: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """``(source_no, block, shard)`` for every block of ``(source_no, quota)``."""
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_blocks))

    def held(low: int, high: int) -> int:
        """Blocks of the shards from ``low`` to before ``high``."""
        return total // shards * (high - low) + max(0, min(high, total % shards) - low)

    def halve(key, node: pd.DataFrame) -> pd.DataFrame:
        low, high = map(int, key)
        if high - low == 1:
            return node
        node, middle = node.sort_values("source_no"), (low + high) // 2
        quota = node["quota"].to_numpy()
        left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(
            quota, held(low, middle), method="marginals")
        halves = [node.assign(low=a, high=b, quota=q) for a, b, q in ((low, middle, left), (middle, high, quota - left))]
        out = pd.concat(halves)
        return out[out["quota"] > 0]

    nodes = quotas.select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "source_no", "quota")
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        nodes = nodes.groupBy("low", "high").applyInPandas(halve, "low int, high int, source_no int, quota long")
    ahead = Window.partitionBy("source_no").orderBy("low")
    upto = F.sum("quota").over(ahead)
    leaves = nodes.select("source_no", F.col("low").alias("shard"), (upto - F.col("quota")).alias("first"), upto.alias("end"))
    return stored(leaves.select("source_no", "shard", F.explode(F.sequence("first", F.col("end") - 1)).alias("block")),
                  "mix-blocks")


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with their counts, and a row ``(key, occurrence, size,
    copy, shard)`` for each time that one is taken."""
    sizes = word_counts(docs)
    sources = source_targets(sizes)
    rows = stored(drawn(permuted(sizes, sources), sources), "mix-drawn")
    taken = draws(rows)
    quotas = taken.groupBy("source_no").agg((F.max("block") + 1).alias("quota"))
    taken = taken.join(splitting_tree(stored(quotas, "mix-quotas")), ["source_no", "block"])
    return rows, taken.select("key", "occurrence", "size", "copy", "shard")


def taken_words(docs: DataFrame) -> DataFrame:
    """For every document the words that the mix takes of it."""
    rows, taken = plan(docs)
    sums = taken.groupBy("key", "occurrence").agg(F.sum("size").alias("taken"), F.count(F.lit(1)).alias("copies"))
    out = rows.drop("copies").join(sums, ["key", "occurrence"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                      F.coalesce("copies", F.lit(0)).cast("long").alias("copies"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed documents, with all their columns, shard by shard; a document
    that is taken twice is there twice."""
    _, taken = plan(docs)
    # a list is as long as a document is taken, MOST at most
    key, nth, turns, turn = free_names(docs, "__key", "__nth", "__draws", "__draw")
    lists = taken.groupBy(F.col("key").alias(key), F.col("occurrence").alias(nth)).agg(F.collect_list(F.struct(
        "shard", F.xxhash64("key", "occurrence", "copy", F.lit(seed)).alias("turn"))).alias(turns))
    rows = docs.withColumn(key, _key())
    rows = rows.withColumn(nth, _occurrence(key, F.xxhash64(whole_text())))
    rows = rows.join(lists, [key, nth]).withColumn(turn, F.explode(turns))
    rows = rows.repartition(f"{turn}.shard").sortWithinPartitions(f"{turn}.shard", f"{turn}.turn")
    return rows.select(*docs.columns)
