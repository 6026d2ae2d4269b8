"""Document fingerprints from closed syncmers, in DataFrame expressions.

The units are words; what a word has beyond ``LONG`` code points are so many
units more, its characters, as are those of a script that is written without
blanks.  Of every run of ``K`` words (a k-mer) the hashes of its
runs of ``S`` words are compared: the k-mer is chosen when the smallest of
them is the first or the last (a closed syncmer).  Whether a k-mer is chosen
depends on nothing but its own words, so equal passages have equal anchors at
equal distances wherever they stand.  A fingerprint is the list of anchors in
text order, each 32 bits of its k-mer's hash as 8 hexadecimal digits.  Where
no k-mer is chosen (only in texts of fewer than ``2 * K - S - 1`` units), the one of
the smallest hash is; a text of fewer than ``K`` units has one anchor, the
hash of all of them; a text without words has none.

``likeness`` of two fingerprints is the share of their different anchors that
both have: 1 for equal ones (two empty ones too), 0 without a common one.
``offsets`` matches two lists of anchors by position.

Each document is compared with the next one by descending id, without
bringing all documents together: ids are dealt to blocks of about
``PER_BLOCK`` by value, neighbours within a block meet in a window, and the
first document of each block is also sent to the block above, after its rows.
There are at most ``MOST_BLOCKS`` blocks, so the table of first documents is
small enough to broadcast at any size.

Defined results: a null text counts as empty; null ids come last; rows with
one id are ordered by their texts; the only document of a table is its own
next one; an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationspark.llm.shared import SPACES, let, whole_text

#: Words of an anchor, and of the runs compared inside it.
K = 5
S = 2
#: Code points of a word that are one unit.
LONG = 32
# Blocks of scripts written without blanks (fixed values): Thai, Lao, Tibetan,
# Myanmar, Khmer, Han, Hiragana, Katakana.  Ranges, for a look at a character's
# script takes many times longer.
_SCRIPTS = (r"\u0E00-\u0E7F\u0E80-\u0EFF\u0F00-\u0FFF\u1000-\u109F\u1780-\u17FF\u19E0-\u19FF\u2E80-\u2FDF\u3005-\u3007"
            r"\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{323AF}")
_ABOVE_LATIN = r"[\u0E00-\x{10FFFF}]"
_UNSPACED = f"[{_SCRIPTS}]"
_UNIT = f"(?s)^[^{_SCRIPTS}]{{1,{LONG}}}|."
PER_BLOCK = 256
MOST_BLOCKS = 65_536


def _units(words: Column) -> Column:
    """Beginnings of words, and characters; asked for only where a text has such."""
    return F.flatten(F.transform(words, lambda w: F.regexp_extract_all(w, F.lit(_UNIT), F.lit(0))))


def _word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(text, SPACES, -1), "")
    # one look at the text for its script, one at the words' lengths
    unspaced = text.rlike(_ABOVE_LATIN) & text.rlike(_UNSPACED)
    cut = lambda ws: unspaced | F.exists(ws, lambda w: F.length(w) > LONG)
    return let(words, lambda ws: F.transform(F.when(cut(ws), _units(ws)).otherwise(ws), lambda w: F.xxhash64(w)))


def anchors(text: Column) -> Column:
    """Array of ``(at, value)`` as one long each: the place of the anchor's
    first word in the upper half, 32 bits of hash in the lower."""

    def chosen(h: Column, s: Column) -> Column:
        last = K - S
        places = F.filter(F.sequence(F.lit(0), F.size(h) - K), lambda i: F.least(
            *[F.get(s, i + j) for j in range(1, last)]) >= F.least(F.get(s, i), F.get(s, i + last)))
        def value(i: Column) -> Column:
            return F.shiftrightunsigned(F.xxhash64(F.get(s, i), F.get(s, i + S), F.get(h, i + K - 1)), 32)

        def smallest() -> Column:
            every = F.sequence(F.lit(0), F.size(h) - K)
            least = F.array_min(F.transform(every, lambda i: F.struct(value(i).alias("value"), i.alias("at"))))
            return F.array(F.shiftleft(least["at"].cast("long"), 32).bitwiseOR(least["value"]))

        return let(places, lambda p: F.when(F.size(p) == 0, smallest()).otherwise(
            F.transform(p, lambda i: F.shiftleft(i.cast("long"), 32).bitwiseOR(value(i)))))

    def of_words(h: Column) -> Column:
        pairs = F.zip_with(h, F.slice(h, 2, F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b))
        return (F.when(F.size(h) >= K, let(pairs, lambda s: chosen(h, s)))
                .when(F.size(h) > 0, F.array(F.shiftrightunsigned(F.xxhash64(h), 32)))
                .otherwise(F.array().cast("array<bigint>")))

    return let(_word_hashes(text), of_words)


def values(found: Column) -> Column:
    """The anchors' hashes alone."""
    return F.transform(found, lambda a: a.bitwiseAND(F.lit(0xFFFFFFFF)))


def printed(hashes: Column) -> Column:
    """The fingerprint as text."""
    return F.lower(F.array_join(F.transform(hashes, lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def offsets(a: Column, b: Column) -> Column:
    """Share of ``a``'s anchors that ``b`` has at the same place."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def with_neighbour_blocks(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, block, guest)``: every document in its block, and the
    first of each block once more, as a guest of the block above."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    blocks = min(MOST_BLOCKS, max(1, math.ceil(n / PER_BLOCK)))
    if low is None or low == high:
        block = F.when(F.col("doc_id").isNull(), 0).otherwise(1)
    else:
        block = F.coalesce(F.width_bucket(F.col("doc_id").cast("double"), F.lit(float(low)),
                                          F.lit(float(high)), F.lit(blocks)), F.lit(0))
    rows = rows.withColumn("block", block.cast("long"))
    order = Window.orderBy("block")
    heads = (rows.groupBy("block").agg(F.max("doc_id").alias("head"))
             .select("head", F.coalesce(F.lead("block").over(order), F.min("block").over(Window.partitionBy())).alias("above")))
    sent = rows.join(F.broadcast(heads), rows["doc_id"].eqNullSafe(heads["head"]), "left")
    places = F.array_compact(F.array(F.struct("block", F.lit(0).alias("guest")), F.when(
        F.col("above").isNotNull(), F.struct(F.col("above").alias("block"), F.lit(1).alias("guest")))))
    return sent.select("doc_id", "text", F.inline(places))


def fingerprint(docs: DataFrame) -> DataFrame:
    """``(doc_id, anchors)`` of every text."""
    return docs.select("doc_id", anchors(whole_text()).alias("anchors"))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text (the last third
    replaced by the beginning of the next document), and both likenesses."""
    order = Window.partitionBy("block").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    rows = with_neighbour_blocks(docs).withColumn("next_text", F.lead("text").over(order))
    n = F.length("text")
    third = (n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))
    rows = (rows.withColumn("edited", F.when(F.col("guest") == 0, edited).otherwise(F.lit("")))
            .withColumn("anchors", anchors(F.col("text")))
            .withColumn("edited_anchors", anchors(F.col("edited"))))
    rows = (rows.withColumn("own", values(F.col("anchors"))).withColumn("other", values(F.col("edited_anchors")))
            .withColumn("next", F.lead("own").over(order)).filter("guest = 0"))
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("own")).alias("fingerprint"), printed(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
        offsets(F.col("anchors"), F.col("edited_anchors")).alias("same_place"))
