"""Vector codes: exact product quantisation over Hilbert-sorted flat blocks.

Every vector is cut into parts; the parts of one position share a codebook,
which rounds of assignment and averaging settle.  The parts of a position are
put in the order of a Hilbert curve and cut into flat blocks of ``BLOCK``
rows, so that a block's rows lie near each other.  A block stores the least
and greatest value of each component (its box) and the components' sums.

In a round the distances from the entries to a block's box give a shortlist:
an entry is left out if even its least distance to the box is greater than
the greatest distance of some other entry, for then it is nearest to no row
of the block, and ties with none.  A block with one entry left hands on its
stored sums; another compares its rows with the entries of the shortlist, in
integers.  Only sums and counts for each entry leave the tasks; the codebooks
(``ENTRIES`` rows for each position) are what the driver holds.

Defined results: rows take no part whose vector is null or holds a null or
non-finite component, nor those of another length than the row of the
smallest id; that length is cut as evenly as whole components allow.  Rows
are ordered by id, those without one last, those of one id by their vectors.
Of fewer rows than ``ENTRIES`` each begins an entry.  Components beyond
``LIMIT`` count as that limit.  An empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationspark.llm import vectors as vec
from stationspark.llm.shared import stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMIT = 1 << 29
#: Rows of a block, and of a range of the curve.
BLOCK = 256
RANGE = 1 << 15
MOST_RANGES = 4096
#: Coordinates of a part that the curve runs through, and bits of each.
CURVE_AXES, CURVE_BITS = 8, 7
#: Rows that the curve's grid is laid over.
SAMPLE = 2048

PIECES = "part int, place long, row_id long, vec_id long, label long, piece array<long>"
BLOCKS = ("part int, n int, low array<long>, high array<long>, total array<long>, pieces array<long>, "
          "row_ids array<long>, vec_ids array<long>, labels array<long>")
SUMS = "part int, entry int, position int, total long"
CODES = "row_id long, vec_id long, label long, part int, entry int, distance long"

Book = list[np.ndarray]


def cuts(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


# -------------------------------------------------------------- curve ------

def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells (``bits`` for each
    coordinate): the axes are turned cell half by cell half, Gray coded, and
    their bits interleaved."""
    x = [c.astype(np.uint64) for c in cells.T]
    one, n = np.uint64(1), len(x)
    for b in range(bits - 1, 0, -1):
        half, below = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(n):
            upper = (x[i] & half) != 0
            swap = np.where(upper, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] = np.where(upper, x[0] ^ below, x[0]) ^ swap
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & one, (one << np.uint64(b)) - one, np.uint64(0))
    place = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            place = place << one | ((axis ^ turn) >> np.uint64(b)) & one
    return place.astype(np.int64)


def grid_cells(pieces: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Cells of the grid between ``low`` and ``high``; what lies outside is at its edge."""
    n = min(CURVE_AXES, pieces.shape[1])
    width = np.maximum(high[:n] - low[:n], 1)
    return np.clip((pieces[:, :n] - low[:n]) * (1 << CURVE_BITS) // width, 0, (1 << CURVE_BITS) - 1)


def _pieces(spans: list[tuple[int, int]], low: np.ndarray, high: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = vec.arrow_schema(PIECES)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = vec.table_of(batch.column("vector"))
            for part, (a, b) in enumerate(spans):
                piece = values[:, a:b]
                place = hilbert_place(grid_cells(piece, low[a:b], high[a:b]), CURVE_BITS) if b > a \
                    else np.zeros(len(piece), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(piece), part, np.int32)), pa.array(place), batch.column("row_id"),
                     batch.column("vec_id"), batch.column("label"), vec.lists(np.ascontiguousarray(piece))], schema=schema)

    return run


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = vec.arrow_schema(BLOCKS)
        for batch in batches:
            out: list[tuple] = []
            parts = batch.column("part").to_numpy()
            edges = np.flatnonzero(np.diff(parts)) + 1
            for start, end in zip([0, *edges], [*edges, len(parts)]):
                for at in range(start, end, size):
                    rows = batch.slice(at, min(size, end - at))
                    values = vec.table_of(rows.column("piece"))
                    out.append((int(parts[at]), len(values), values.min(0), values.max(0), values.sum(0), values.reshape(-1),
                                *(rows.column(c).to_pylist() for c in ("row_id", "vec_id", "label"))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


# -------------------------------------------------------------- rounds -----

def _wide(*values: np.ndarray) -> bool:
    most = sum(vec.largest(v) for v in values)
    return most * most * max(1, values[0].shape[-1]) >= 1 << 62


def distances(pieces: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows and entries."""
    if _wide(pieces, entries):
        pieces, entries = pieces.astype(object), entries.astype(object)
    return ((pieces[:, None, :] - entries) ** 2).sum(-1)


def box_distances(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of each box and entry."""
    if _wide(low, entries) or _wide(high, entries):
        low, high, entries = (v.astype(object) for v in (low, high, entries))
    below, above = low[:, None, :] - entries, entries - high[:, None, :]
    least = np.maximum(np.maximum(below, above), 0)
    most = np.maximum(abs(below), abs(above))
    return (least ** 2).sum(-1), (most ** 2).sum(-1)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each box the entries that can be nearest to a row of it."""
    least, most = box_distances(low, high, entries)
    return (least <= most.min(1)[:, None]).astype(bool)


def _assigned(batch: pa.RecordBatch, book: Book) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(row of the batch, part, shortlist, pieces)`` of each block."""
    parts = batch.column("part").to_numpy()
    for part in np.unique(parts).tolist():
        at = np.flatnonzero(parts == part)
        take = pa.array(at)
        low, high = (vec.table_of(batch.column(c).take(take)) for c in ("low", "high"))
        for i, short in zip(at.tolist(), shortlists(low, high, book[part])):
            pieces = batch.column("pieces")[i].values.to_numpy().reshape(batch.column("n")[i].as_py(), low.shape[1])
            yield i, part, np.flatnonzero(short), pieces


def _sums(book: Book):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in book]
        for batch in batches:
            for i, part, short, pieces in _assigned(batch, book):
                if len(short) == 1:
                    totals[part][short[0], :-1] += batch.column("total")[i].values.to_numpy()
                    totals[part][short[0], -1] += batch.column("n")[i].as_py()
                    continue
                nearest = distances(pieces, book[part][short]).argmin(1)
                for j, entry in enumerate(short.tolist()):
                    own = pieces[nearest == j]
                    totals[part][entry, :-1] += own.sum(0)
                    totals[part][entry, -1] += len(own)
        for part, total in enumerate(totals):
            entry, position = (x.reshape(-1) for x in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(total.size, part, np.int32)), pa.array(entry.astype(np.int32)),
                 pa.array(position.astype(np.int32)), pa.array(total.reshape(-1))], schema=vec.arrow_schema(SUMS))

    return run


def _codes(book: Book):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, part, short, pieces in _assigned(batch, book):
                all_distances = distances(pieces, book[part][short])
                nearest, n = all_distances.argmin(1), len(pieces)
                distance = np.minimum(all_distances[np.arange(n), nearest], 1 << 59).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[i].values for c in ("row_ids", "vec_ids", "labels")] +
                    [pa.array(np.full(n, part, np.int32)), pa.array(short[nearest].astype(np.int32)), pa.array(distance)],
                    schema=vec.arrow_schema(CODES))

    return run


def next_book(blocks: DataFrame, book: Book) -> Book:
    """Each entry at the floor of its rows' mean; one without rows stays."""
    sums = blocks.mapInArrow(_sums(book), SUMS).groupBy("part", "entry", "position").agg(F.sum("total").alias("total"))
    totals = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in book]
    for part, entry, position, total in sums.collect():  # ENTRIES rows for each component and part
        totals[part][entry, position] = total
    return [np.where(t[:, -1:] > 0, t[:, :-1] // np.maximum(t[:, -1:], 1), b) for t, b in zip(totals, book)]


def book_sha256(book: Book) -> str:
    return hashlib.sha256(",".join(str(x) for b in book for x in b.reshape(-1).tolist()).encode()).hexdigest()


def flat_blocks(rows: DataFrame, n_rows: int, length: int, parts: int = PARTS, size: int = BLOCK) -> DataFrame:
    """The stored blocks of every part of ``rows``."""
    drawn = rows.select("vector").orderBy(F.xxhash64("row_id"), "row_id").limit(SAMPLE).collect()
    sample = np.array([r["vector"] for r in drawn], dtype=np.int64).reshape(len(drawn), length)
    low, high = sample.min(0), sample.max(0) + 1
    ranges = max(1, min(MOST_RANGES, -(-n_rows * parts // RANGE)))
    order = ["part", "place", "row_id"]
    pieces = rows.mapInArrow(_pieces(cuts(length, parts), low, high), PIECES)
    laid = pieces.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return stored(laid.mapInArrow(_blocks(size), BLOCKS), "flat-blocks")


def encode(table: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
           block: int = BLOCK) -> DataFrame:
    """``(vec_id, label, code, error, label_error, codebooks_sha256)``."""
    rows = stored(vec.integer_rows(table, scale, LIMIT), "vectors")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector", "row_id").limit(1).collect()
    length = first[0]["dim"] if first else 0
    rows = rows.filter(F.col("dim") == length)
    begin = rows.orderBy(F.asc_nulls_last("vec_id"), "vector", "row_id").limit(entries).collect() if first else []
    start = np.array([r["vector"] for r in begin], dtype=np.int64).reshape(len(begin), length)
    book = [start[:, a:b] for a, b in cuts(length, parts)]
    if first:
        blocks = flat_blocks(rows, table.count(), length, parts, block)
        for _ in range(rounds):
            book = next_book(blocks, book)
        coded = blocks.mapInArrow(_codes(book), CODES)
    else:
        coded = table.sparkSession.createDataFrame([], CODES)
    code = F.concat(*[F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("entry"))).cast("long"))), 2, "0")
                      for p in range(parts)])
    coded = stored(coded.groupBy("row_id", "vec_id", "label").agg(code.alias("code"), F.sum("distance").alias("error")), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(book_sha256(book)).alias("codebooks_sha256"))
