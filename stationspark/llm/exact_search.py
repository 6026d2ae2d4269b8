"""Exact top-k search by inner product, by elimination over a pivot table.

Some rows are pivots, chosen farthest-first from a bounded sample; the table
of every row's distances to them is computed once and stored.  For a query q
and a row c the triangle inequality gives

    |q - c|  >=  max over pivots p of | |q - p| - |c - p| |

and with the two norms the greatest inner product that c can have.  Rows are
evaluated in the order of that bound, in growing groups, until no bound that
is left reaches the k-th score; equal bounds are evaluated, as ties go to the
smaller id.

Rows lie in lanes, in the order of their nearest pivot and distance to it.  A
query is first searched in its own block, which gives it a k-th score to
begin with; then in the blocks of those lanes whose ranges of pivot distances
leave a bound that reaches that score.  Every query's best of each block meet
in a window that keeps k of them.

Defined results: rows take no part whose vector is null or holds a null or
non-finite component; a query meets all rows of its own vector length but
itself, also those of its id; an id of null is no query and comes last among
ties; of fewer than k rows all are returned; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationspark.llm import vectors as vec
from stationspark.llm.shared import stored

SCALE = 64
K = 20
EVERY = 20
#: Pivots for each vector length, and rows that they are chosen from.
PIVOTS = 32
SAMPLE = 2048
#: Rows evaluated first for a query; each further group is this many times larger.
FIRST = 128
GROWTH = 4
#: Queries whose bounds are computed together, and those handed on together.
TOGETHER = 16
HANDED = 256

PLACED = f"{vec.ROW}, distances array<double>, norm double, cell int, own double"
FOUND = ("row_id long, vec_id long, dim int, vector array<long>, distances array<double>, norm double, "
         "lane int, block int, scores array<long>, ids array<long>, numbers array<long>")


# ------------------------------------------------------------- pivots ------

def farthest_first(rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows (all different ones, if fewer), each the farthest from those before."""
    values = rows.astype(np.float64)
    chosen, nearest = [0], ((values - values[0]) ** 2).sum(1)
    while len(chosen) < n and nearest.max(initial=0) > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((values - values[chosen[-1]]) ** 2).sum(1))
    return values[chosen]


def pivots_of(rows: DataFrame, n: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Pivots for each vector length in a sample of at most ``sample`` rows."""
    drawn = rows.select("dim", "vector").orderBy(F.xxhash64("row_id"), "row_id").limit(sample).collect()
    by_length: dict[int, list] = {}
    for row in drawn:
        by_length.setdefault(row["dim"], []).append(row["vector"])
    return {dim: farthest_first(np.array(v, dtype=np.int64).reshape(len(v), dim), n) for dim, v in by_length.items()}


def placed(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Each row with its distances to the pivots of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = vec.arrow_schema(PLACED)
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                values = vec.table_of(part.column("vector")).astype(np.float64)
                with np.errstate(over="ignore"):
                    far = np.stack([np.sqrt(((values - p) ** 2).sum(1)) for p in pivots[dim]], 1) \
                        if dim in pivots else np.zeros((len(values), 0))
                cell = far.argmin(1) if far.shape[1] else np.zeros(len(values), int)
                own = far.min(1) if far.shape[1] else np.zeros(len(values))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, vec.lists(far), pa.array((values ** 2).sum(1)),
                     pa.array(cell.astype(np.int32)), pa.array(own)], schema=schema)

    return rows.mapInArrow(run, PLACED)


def bounds(q_far: np.ndarray, q_norm: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """The greatest inner products of queries (rows) with anything whose pivot
    distances lie in ``low`` to ``high`` (pivots by things; the same array
    twice for rows) and whose squared norm is at most ``norm``.  In single
    precision, with allowance for its rounding."""
    shape = (len(q_far), len(norm))
    least, gap = np.zeros(shape, np.float32), np.empty(shape, np.float32)
    q_far = q_far.astype(np.float32)
    for p in range(q_far.shape[1]):
        of_q = q_far[:, p:p + 1]
        np.subtract(of_q, high[p], out=gap)
        if low is high:
            np.abs(gap, out=gap)
        else:
            np.maximum(least, low[p] - of_q, out=least)
        np.maximum(least, gap, out=least)
    if q_far.size and high.size:
        least -= np.float32(5e-7) * max(q_far.max(), high.max())
        np.maximum(least, 0, out=least)
    both = q_norm[:, None] + norm
    return (both * (1 + 1e-6) - least.astype(np.float64) ** 2) / 2 + 1e-3


# ------------------------------------------------------------- search ------

class Rows:
    """Rows of one length, from an Arrow table."""

    def __init__(self, table: pa.Table, dim: int | None = None):
        self.table = table if dim is None else table.filter(pa.array(table["dim"].to_numpy() == dim))
        self.vectors = vec.table_of(self.table["vector"])
        self.distances = vec.table_of(self.table["distances"])
        self.norm = self.table["norm"].to_numpy()
        self.number = self.table["row_id"].to_numpy()
        self.known = self.table["vec_id"].is_valid().to_numpy()
        self.vec_id = self.table["vec_id"].fill_null(0).to_numpy()


def best(found: tuple[np.ndarray, np.ndarray], rows: Rows, k: int) -> tuple[np.ndarray, np.ndarray]:
    at, scores = found
    order = np.lexsort((rows.number[at], rows.vec_id[at], ~rows.known[at], -scores))[:k]
    return at[order], scores[order]


def eliminate(bound: np.ndarray, query: np.ndarray, values: np.ndarray, k: int, floor: float):
    """Candidates and scores that may be among the best k, and how many rows
    were evaluated.  ``floor``: a score that k rows elsewhere reach."""
    left = np.flatnonzero(bound >= floor)
    at, scores, group, n = np.zeros(0, np.int64), np.zeros(0, np.int64), max(FIRST, k), 0
    while left.size:
        if left.size > group:
            order = np.argpartition(-bound[left], group)
            now, left = left[order[:group]], left[order[group:]]
        else:
            now, left = left, left[:0]
        n += now.size
        at = np.concatenate([at, now])
        scores = np.concatenate([scores, (values.take(now, axis=0) @ query).astype(np.int64)])
        if scores.size >= k:
            floor = max(floor, np.partition(scores, scores.size - k)[scores.size - k])
            keep = scores >= floor
            at, scores = at[keep], scores[keep]
            left = left[bound[left] >= floor]
        group *= GROWTH
    return at, scores, n


def search(queries: Rows, rows: Rows, k: int, floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and scores of its best k rows, itself left out."""
    size = queries.vectors.shape[1] * vec.largest(queries.vectors) * vec.largest(rows.vectors)
    kind = np.float32 if size < 1 << 24 else np.float64 if size < vec.EXACT else object
    q_values, values = queries.vectors.astype(kind), rows.vectors.astype(kind)
    place = {int(n): i for i, n in enumerate(rows.number)}
    far = np.ascontiguousarray(rows.distances.T, dtype=np.float32)
    out = []
    for start in range(0, len(q_values), TOGETHER):
        part = slice(start, start + TOGETHER)
        bound = bounds(queries.distances[part], queries.norm[part], far, far, rows.norm)
        for i, own in enumerate(bound):
            itself = place.get(int(queries.number[start + i]))
            if itself is not None:
                own[itself] = -np.inf
            if kind is object:
                found = limited(own, q_values[start + i], values, k, floors[start + i], itself)
            else:
                found = eliminate(own, q_values[start + i], values, k, floors[start + i])[:2]
            keep = found[0] != (-1 if itself is None else itself)
            out.append(best((found[0][keep], found[1][keep]), rows, k))
    return out


def limited(bound, query, values, k, floor, itself):
    """Beyond whole numbers of doubles: Python's integers, a long's limits."""
    at = np.flatnonzero(bound >= floor)
    scores = np.clip(values[at] @ query, -(1 << 63), (1 << 63) - 1).astype(np.int64) if at.size else np.zeros(0, np.int64)
    return at, scores


def _given(queries: pa.Table, rows: Rows, found: list, lane: int, block: int) -> pa.Table:
    ids = rows.table["vec_id"].combine_chunks()
    ends = np.cumsum([0, *(len(f[0]) for f in found)]).astype(np.int32)
    at = np.concatenate([np.zeros(0, np.int64), *(f[0] for f in found)])
    scores = np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)])
    lists = {"scores": pa.array(scores), "ids": ids.take(pa.array(at)), "numbers": pa.array(rows.number[at])}
    n = len(queries)
    columns = {name: queries[name] for name in ("row_id", "vec_id", "dim", "vector", "distances", "norm")} | {
        "lane": pa.array([lane] * n, pa.int32()), "block": pa.array([block] * n, pa.int32())} | {
        name: pa.ListArray.from_arrays(ends, v) for name, v in lists.items()}
    return pa.table(columns)


def _empty() -> pa.Table:
    return vec.arrow_schema(FOUND).empty_table()


def _at_home(k: int, every: int):
    def run(block: pa.Table) -> pa.Table:
        out = [_empty()]
        lane, number = block["lane"][0].as_py(), block["block"][0].as_py()
        ids = block["vec_id"]
        asks = ids.is_valid().to_numpy() & (ids.fill_null(1).to_numpy() % every == 0)
        for dim in np.unique(block["dim"].to_numpy()).tolist():
            rows, queries = Rows(block, dim), block.filter(pa.array(asks & (block["dim"].to_numpy() == dim)))
            if len(queries):
                floors = np.full(len(queries), -np.inf)
                out.append(_given(queries, rows, search(Rows(queries), rows, k, floors), lane, number))
        return pa.concat_tables(t.cast(out[0].schema) for t in out)

    return run


def _elsewhere(k: int):
    def run(page: pa.Table, block: pa.Table) -> pa.Table:
        out = [_empty()]
        if len(page) and len(block):
            lane, number = block["lane"][0].as_py(), block["block"][0].as_py()
            for dim in np.unique(page["dim"].to_numpy()).tolist():
                rows, queries = Rows(block, dim), Rows(page, dim)
                if len(rows.number):
                    out.append(_given(queries.table, rows, search(queries, rows, k, queries.table["floor"].to_numpy()),
                                      lane, number))
        return pa.concat_tables(t.cast(out[0].schema) for t in out)

    return run


def lane_ranges(rows: DataFrame, pivots: int) -> DataFrame:
    """For each lane and vector length: its blocks, ranges of pivot distances, greatest norm."""
    return rows.groupBy("lane", "dim").agg(
        F.min("block").alias("first"), F.max("block").alias("last"), F.max("norm").alias("norm"),
        F.array(*[F.min(F.get("distances", F.lit(p))) for p in range(pivots)]).alias("low"),
        F.array(*[F.max(F.get("distances", F.lit(p))) for p in range(pivots)]).alias("high"))


def _asked(ranges: dict[int, tuple], k: int, n_pages: int):
    """Queries for the blocks of the lanes that may hold one of their best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, HANDED):
                part = batch.slice(start, HANDED)
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    of = part.filter(pa.array(dims == dim))
                    lane, first, n, norm, low, high = ranges[dim]
                    scores = of.column("scores")
                    floors = np.array([s[-1].as_py() if len(s) >= k else -np.inf for s in scores], dtype=float)
                    reach = bounds(vec.table_of(of.column("distances")), of.column("norm").to_numpy(), low, high, norm)
                    q, at = np.nonzero(reach >= floors[:, None])
                    q, to = np.repeat(q, n[at]), np.repeat(at, n[at])
                    block = first[to] + np.arange(len(to)) - np.repeat(np.cumsum(n[at]) - n[at], n[at])
                    home = (lane[to] == of.column("lane").to_numpy()[q]) & (block == of.column("block").to_numpy()[q])
                    q, to, block = q[~home], to[~home], block[~home]
                    took = of.select(["row_id", "vec_id", "dim", "vector", "distances", "norm"]).take(pa.array(q))
                    # a page for each query, the same in every block
                    page = (of.column("row_id").to_numpy()[q] * 2_654_435_761 % (1 << 32) * n_pages >> 32).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*took.columns, pa.array(lane[to].astype(np.int32)), pa.array(block.astype(np.int32)),
                         pa.array(page), pa.array(floors[q])],
                        names=[*took.schema.names, "lane", "block", "page", "floor"])

    return run


ASKED = ("row_id long, vec_id long, dim int, vector array<long>, distances array<double>, norm double, "
         "lane int, block int, page int, floor double")


def top_k(table: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, pivots: int = PIVOTS,
          block: int = vec.BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best ``k`` of every row whose id
    is divisible by ``every``."""
    rows, n = stored(vec.integer_rows(table, scale), "vectors"), table.count()
    chosen = pivots_of(rows, pivots)
    width = max((len(p) for p in chosen.values()), default=0)
    laid = vec.in_lanes(placed(rows, chosen), ["dim", "cell", "own", "row_id"], n, block)
    laid = stored(laid, "pivot-table")
    home = stored(laid.groupBy("lane", "block").applyInArrow(_at_home(k, every), FOUND), "found-at-home")
    ranges: dict[int, list] = {}
    for r in lane_ranges(laid, width).collect() if width else []:
        here = len(chosen.get(r["dim"], ()))
        ranges.setdefault(r["dim"], []).append(
            (r["lane"], r["first"], r["last"] - r["first"] + 1, r["norm"], r["low"][:here], r["high"][:here]))
    tables = {dim: tuple(np.array(c, dtype=np.int64 if i < 3 else np.float64).T for i, c in enumerate(zip(*of)))
              for dim, of in ranges.items()}
    n_pages = vec.pages(home.count())
    asked = home.mapInArrow(_asked(tables, k, n_pages), ASKED)
    found = vec.meet(asked, laid, n_pages, _elsewhere(k), FOUND)
    pairs = home.unionByName(found).select(
        F.col("row_id").alias("query"), F.col("vec_id").alias("query_id"),
        F.explode(F.arrays_zip("scores", "ids", "numbers")).alias("of"))
    order = Window.partitionBy("query").orderBy(F.desc("of.scores"), F.asc_nulls_last("of.ids"), "of.numbers")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("of.ids").alias("vec_id"), F.col("of.scores").alias("score"))
