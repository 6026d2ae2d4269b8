"""Packing documents into token windows by Karmarkar-Karp differencing.

Each task packs the documents of its partition; nothing is shuffled.  A
document's ids, its end id included, fill whole windows as long as they can.
What remains is cut into pieces of at most ``PIECE`` tokens, and the pieces
of many documents make a batch of ``WINDOWS`` windows, less a small slack.

A batch is split into ``k`` windows by multiway differencing: every piece
begins as a partial partition with one window filled; the two partial
partitions of the largest imbalance are merged so that the fullest window of
one meets the emptiest of the other, until one is left.  Its windows are
nearly equal.  If one is over the capacity, ``k`` rises by one and the batch
is split anew.

Defined results: a null text counts as empty, which is one id (the end id);
a repeated row is packed again; an empty table gives no rows; extra columns
are ignored.  ``sequence_id`` holds the partition in its upper bits and
counts within it.  The same partitions give the same windows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationspark.llm.shared import whole_text
from stationspark.llm.token_output import END_ID, TOKENIZER
from stationspark.llm.tokens import encoder

CAPACITY = 1024
PIECE = 128
#: Windows of a batch, and the tokens that a batch leaves free in each.
WINDOWS = 32
SLACK = 12

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "ids_crc32 long")


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """The items of each of ``k`` near-equal subsets."""
    heap = []
    for i, size in enumerate(sizes):
        # (imbalance, tie, sums from the fullest down, their items)
        heap.append((-size, i, [size] + [0] * (k - 1), [[i]] + [[] for _ in range(k - 1)]))
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b))]
        items = [x + y for x, y in zip(a_items, reversed(b_items))]
        order = sorted(range(k), key=sums.__getitem__, reverse=True)
        sums = [sums[j] for j in order]
        heapq.heappush(heap, (sums[-1] - sums[0], tie, sums, [items[j] for j in order]))
        tie += 1
    return heap[0][3]


def split(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows within the capacity; their number rises as long as one is not."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


def _packed(tokenizer: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        waiting: list[tuple] = []
        held, room = 0, WINDOWS * (CAPACITY - SLACK)

        def row(piece: tuple, offset: int) -> tuple:
            doc_id, start, ids, n = piece
            last = ids.astype(np.int64) if with_ids else zlib.crc32(ids)
            return doc_id, start, len(ids), n, sequence, offset, last

        def flush() -> None:
            nonlocal sequence
            for window in split([len(p[2]) for p in waiting]) if waiting else ():
                offset = 0
                for i in sorted(window):
                    out.append(row(waiting[i], offset))
                    offset += len(waiting[i][2])
                sequence += 1
            waiting.clear()

        def given() -> pa.RecordBatch:
            names = [c.split()[0] for c in PIECES.split(", ")]
            types = [pa.int64()] * 6 + [pa.list_(pa.int64()) if with_ids else pa.int64()]
            names[-1] = "ids" if with_ids else names[-1]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for first, ids, ends in own.encoded(batch.column(1), END_ID):
                for doc_id, begin, end in zip(numbers[first:], [0, *ends], ends):
                    n, at = end - begin, 0
                    while n - at >= CAPACITY:
                        out.append(row((doc_id, at, ids[begin + at:begin + at + CAPACITY], n), 0))
                        sequence += 1
                        at += CAPACITY
                    while at < n:
                        size = min(PIECE, n - at, room - held)
                        waiting.append((doc_id, at, ids[begin + at:begin + at + size], n))
                        at, held = at + size, held + size
                        if held == room:
                            flush()
                            held = 0
                    if len(out) >= 8192:
                        yield given()
        flush()
        if out:
            yield given()

    return run


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """A row for each piece: its document, place there, length, the document's
    tokens, its window and place there, and the ids' checksum or the ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    columns = PIECES.replace("ids_crc32 long", "ids array<long>") if with_ids else PIECES
    return rows.mapInArrow(_packed(tokenizer, with_ids), columns)
