"""Passages that repeat across documents, by level-wise doubling.

A passage of ``WINDOW`` (50) words is removed where its words also start a
window in a document of smaller id.

Whole copies.  Of documents with one text, the one of the smallest id goes
on; every window of the others starts in it too.

Level 25.  Not every run of 25 words is looked at: of the runs inside a window
of 50, the one with the smallest hash (the leftmost of equal ones) is its
anchor.  Equal windows have equal anchors at equal places, so a window can
only repeat if its anchor does.  Anchors that occur in one document only end
here; about one word in thirteen starts an anchor.

Level 50.  The windows of a repeated anchor are neighbours.  Anchors whose
windows are equal all together form a class; in all but the documents of its
smallest id, every window of the class repeats.  Only where an anchor has
several classes, the windows of those smallest documents go on to be compared
one by one, however many copies there are.

Levels 100, 200, ...  An anchor that repeats at one length is extended to
twice that length, to the right, until none repeats.  The longest length per
document is given as ``longest``; what is removed is decided at 50.

``remove`` covers the words of all repeated windows and gives what is left.
Texts travel compressed; they are moved twice, to their anchors that repeat
and to what is to be removed.

Defined results: words are runs without ASCII white space; a null text has
none; texts of fewer than 50 words stay whole; a repeated row is not smaller
than its twin and both are treated alike; a row with a null id is left whole
and is compared with none; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationspark.llm.shared import packed, stored, unpacked, whole_text
from stationspark.llm.shingles import Runs, hashed

WINDOW = 50
BASE = WINDOW // 2
#: Spans that a task holds before it hands them on.
HELD_SPANS = 20_000

ANCHORS = "doc_id long, h long"
SPANS = ("doc_id long, th long, at int, first int, last int, h long, span long, windows array<long>, "
         "longer array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    """``th`` tells rows with one id and different texts apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.withColumn("th", F.xxhash64("text"))


def _anchor_of_windows(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the base runs, and the start of each window's anchor."""
    base = runs.all(BASE)
    inside = np.lib.stride_tricks.sliding_window_view(base, WINDOW - BASE + 1)
    return base, np.arange(len(inside)) + inside.argmin(axis=1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        owner, h = [], []
        for i, words in hashed(batch.column("text")):
            if len(words) < WINDOW or doc_ids[i] is None:
                continue
            base, anchors = _anchor_of_windows(Runs(words))
            # a run that a document repeats counts once
            here = np.unique(base[np.unique(anchors)])
            owner.append(np.full(len(here), doc_ids[i]))
            h.append(_signed(here))
        if owner:
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(np.concatenate(owner), pa.int64()),
                                              "h": pa.array(np.concatenate(h), pa.int64())})


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
             pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [c.split()[0] for c in SPANS.split(", ")]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        doc_ids, ths = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
        for i, words in hashed(pa.array(unpacked(batch.column("packed")), pa.binary())):
            runs = Runs(words)
            if runs.n < WINDOW:
                continue
            base, anchors = _anchor_of_windows(runs)
            windows = _signed(runs.all(WINDOW))
            at = np.unique(anchors)
            wanted = np.asarray(batch.column("repeated")[i].values).view(np.uint64)
            at = at[np.isin(base[at], wanted)]
            first = np.searchsorted(anchors, at)
            last = np.searchsorted(anchors, at, side="right") - 1
            spans = _signed(runs.of(first, last + WINDOW))
            longer = [[] for _ in at]
            length = WINDOW
            while length <= runs.n:
                fits = np.flatnonzero(at + length <= runs.n)
                for j, h in zip(fits, _signed(runs.of(at[fits], at[fits] + length)).tolist()):
                    longer[j].append(h)
                length *= 2
            n = len(at)
            for k, values in enumerate(([doc_ids[i]] * n, [ths[i]] * n, at.tolist(), first.tolist(), last.tolist(),
                                        _signed(base[at]).tolist(), spans.tolist(),
                                        [windows[a:b + 1] for a, b in zip(first, last)], longer)):
                out[k].extend(values)
            if len(out[0]) >= HELD_SPANS:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)
                out = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)


def _repeated(rows: DataFrame, keys: list[str], name: str = "least") -> DataFrame:
    """The keys that occur in more than one document, with the smallest id."""
    return (rows.groupBy(*keys).agg(F.min("doc_id").alias(name), F.max("doc_id").alias("greatest"))
            .filter(F.col(name) < F.col("greatest")).drop("greatest"))


def whole_copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, least, greatest)``: a row for each document, with the
    smallest and the greatest id of those that have its text."""
    texts = _texts(docs).filter("doc_id is not null").select("doc_id", "th", F.xxhash64("text", F.lit(1)).alias("th2"))
    texts = stored(texts, "text-hashes")
    same = texts.groupBy("th", "th2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest"))
    return stored(texts.join(same, ["th", "th2"]).select("doc_id", "th", "least", "greatest"), "whole-copies")


def repeated_spans(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Level 25: the anchors that occur in several documents, each with its
    windows of 50 words and the hashes of its extensions."""
    texts = _texts(docs)
    anchors = texts.select("doc_id", "text").mapInArrow(_anchors, ANCHORS)
    repeated = (anchors.join(_repeated(anchors, ["h"]).select("h"), "h")
                .groupBy("doc_id").agg(F.collect_set("h").alias("repeated")))
    first = copies.filter("doc_id = least").select("doc_id", "th").distinct()
    found = packed(texts).join(repeated.join(first, "doc_id"), ["doc_id", "th"])
    # rows alike in id and text have the same spans: one of them will do
    found = found.select("doc_id", "th", "packed", "repeated").dropDuplicates(["doc_id", "th"])
    return stored(found.mapInArrow(_spans, SPANS), "anchor-spans")


def repeated_windows(spans: DataFrame) -> DataFrame:
    """Level 50: ``(doc_id, th, first, last)``, ranges of starts of windows
    that a document of smaller id has too."""
    same = ["h", "span", "before", "after"]
    spans = spans.withColumns({"before": F.col("at") - F.col("first"), "after": F.col("last") - F.col("at")})
    classes = stored(spans.groupBy(*same).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest")), "span-classes")
    whole = (spans.select("doc_id", "th", "first", "last", *same)
             .join(classes.filter("least < greatest").select("least", *same), same).filter("doc_id > least")
             .select("doc_id", "th", "first", "last"))
    several = classes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    single = (spans.join(classes.join(several, "h").select("least", *same), same).filter("doc_id = least")
              .select("doc_id", "th", "h", "first", "before", F.posexplode("windows").alias("nth", "window"))
              .select("doc_id", "th", (F.col("first") + F.col("nth")).alias("first"), "h",
                      (F.col("before") - F.col("nth")).alias("place"), "window"))
    key = ["h", "place", "window"]
    part = (single.join(_repeated(single, key), key).filter("doc_id > least")
            .select("doc_id", "th", "first", F.col("first").alias("last")))
    return whole.unionByName(part)


def longest_repeats(spans: DataFrame) -> DataFrame:
    """Levels 50, 100, ...: ``(doc_id, th, longest)``, a row for each length at
    which an anchor of the document, extended to the right, occurs in another."""
    found, before, length, level = [], None, WINDOW, 0
    while True:
        rows = spans.select("doc_id", "th", F.get("longer", F.lit(level)).alias("h"),
                            F.get("longer", F.lit(level - 1)).alias("half")).filter("h is not null")
        if before is not None:
            rows = rows.join(before.withColumnRenamed("h", "half"), "half", "left_semi")
        before = stored(_repeated(rows, ["h"]).select("h"), f"level{length}")
        if before.isEmpty():
            return reduce(DataFrame.unionByName, found) if found else before.select(
                F.col("h").alias("doc_id"), F.col("h").alias("th"), F.lit(WINDOW).alias("longest"))
        here = rows.join(before, "h", "left_semi").select("doc_id", "th").distinct()
        found.append(stored(here.withColumn("longest", F.lit(length)), f"found{length}"))
        length, level = 2 * length, level + 1


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept, longest = [], [], [], []
        for text, ranges, copied, later, found in zip(unpacked(batch.column("packed")), *(
                batch.column(c).to_pylist() for c in ("ranges", "copied", "later", "longest"))):
            words = text.split()
            n, left = len(words), words
            if later and n >= WINDOW:
                left = []
            elif ranges:
                steps = np.zeros(n + 1, dtype=np.int64)
                np.add.at(steps, [r["first"] for r in ranges], 1)
                np.add.at(steps, [r["last"] + WINDOW for r in ranges], -1)
                left = [w for w, s in zip(words, (np.cumsum(steps[:-1]) == 0).tolist()) if s]
            while copied and 2 * found <= n and (found or n >= WINDOW):
                found = 2 * found or WINDOW         # a copy repeats at its whole length
            n_words.append(n)
            n_removed.append(n - len(left))
            kept.append(b" ".join(left))
            longest.append(found)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "longest": pa.array(longest, pa.int32())})


def remove(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, longest)`` of every document."""
    copies = whole_copies(docs)
    spans = repeated_spans(docs, copies)
    facts = (repeated_windows(spans).select("doc_id", "th", F.struct("first", "last").alias("range"))
             .unionByName(longest_repeats(spans), allowMissingColumns=True)
             .unionByName(copies.filter("least < greatest").select("doc_id", "th", F.lit(True).alias("copied"),
                                                           (F.col("doc_id") > F.col("least")).alias("later")),
                          allowMissingColumns=True))
    facts = facts.groupBy("doc_id", "th").agg(
        F.collect_set("range").alias("ranges"), F.max("longest").alias("longest"),
        F.bool_or("copied").alias("copied"), F.bool_or("later").alias("later"))
    rows = packed(_texts(docs)).join(facts, ["doc_id", "th"], "left").select(
        "doc_id", "packed", "ranges", F.coalesce("copied", F.lit(False)).alias("copied"),
        F.coalesce("later", F.lit(False)).alias("later"), F.coalesce("longest", F.lit(0)).alias("longest"))
    return rows.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string, longest int")


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
