"""Integer vectors in lanes, and searches of every query against every lane.

What the operators over embeddings share.  A *lane* is a range of the rows in
the order that the operator gives them; it is cut into *blocks* of at most
``BLOCK`` rows.  Queries are cut into *pages*.  A search meets a page with a
block in one task, so that no task holds more than a block and a page.

Components are ``floor(scale * x)`` with x as double, as longs (beyond
``LIMIT`` they are that limit).  A row takes no part whose vector is null or
holds a null or non-finite component.  Vectors meet vectors of their own
length only.  Every row has a number of its own, so rows of one id, with or
without an id, stay rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 4096
PAGE = 4096
#: Lanes at most; what is known of each lane is broadcast, so its size is bounded.
MOST_LANES = 2048
LIMIT = 1 << 62
#: Up to here sums of products are exact in doubles.
EXACT = 1 << 53

ROW = "row_id long, vec_id long, label long, dim int, vector array<long>"


def lists(values: np.ndarray) -> pa.Array:
    """The rows of a table of numbers as an array of lists."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, rows * width + 1, width or 1, dtype=np.int32)
                                    if width else np.zeros(rows + 1, np.int32), pa.array(values.reshape(-1)))


def table_of(column: pa.Array) -> np.ndarray:
    """Lists of one length as a table of numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def integer_components(column: pa.Array, scale: int, limit: int = LIMIT) -> tuple[np.ndarray, pa.Array]:
    """Which rows take part, and their integer vectors."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    fine = np.isfinite(values)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~fine)])
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    took = valid & (bad[ends] == bad[ends - lengths])
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(scale * values[np.repeat(took, lengths)]), -limit, limit).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths[took])]).astype(np.int32)
    return took, pa.ListArray.from_arrays(offsets, pa.array(scaled))


def integer_rows(table: DataFrame, scale: int, limit: int = LIMIT) -> DataFrame:
    """The rows that take part, numbered: ``ROW``."""
    chosen = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            took, vectors = integer_components(batch.column("embedding"), scale, limit)
            mask, n = pa.array(took), len(vectors)
            yield pa.RecordBatch.from_pydict({
                "row_id": pa.array(np.arange(at, at + n)), "vec_id": batch.column("vec_id").filter(mask),
                "label": batch.column("label").filter(mask),
                "dim": pc.list_value_length(vectors).cast(pa.int32()), "vector": vectors})
            at += n

    return chosen.mapInArrow(run, ROW)


def largest(values: np.ndarray) -> int:
    return max(int(values.max()), -int(values.min())) if values.size else 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and of ``b``.

    In doubles where no sum can leave their whole numbers, else in Python's
    integers; beyond a long a product is the long's limit.
    """
    if a.shape[1] * largest(a) * largest(b) < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def in_lanes(rows: DataFrame, order: list[str | Column], n_rows: int, block: int = BLOCK,
             most_lanes: int = MOST_LANES) -> DataFrame:
    """``rows`` in ``order`` with ``lane`` and ``block`` (within the lane).

    Lanes are ranges of ``order``, which has to end in the row number so that
    equal rows are split as well.
    """
    lanes = max(1, min(most_lanes, -(-n_rows // block)))
    ordered = rows.repartitionByRange(lanes, *order).sortWithinPartitions(*order)
    schema = T.StructType([*rows.schema.fields, T.StructField("lane", T.IntegerType()),
                           T.StructField("block", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, lane, np.int32)),
                 pa.array((np.arange(at, at + n) // block).astype(np.int32))], names=[*batch.schema.names, "lane", "block"])
            at += n

    return ordered.mapInArrow(run, schema)


def pages(n_queries: int, page: int = PAGE) -> int:
    return max(1, -(-n_queries // page))


def meet(queries: DataFrame, rows: DataFrame, n_pages: int, search: Callable, schema: str) -> DataFrame:
    """``search(page, block)`` over two Arrow tables, for each page of queries
    and block of rows that share ``lane`` and ``block``.

    ``queries`` come with the lanes and blocks that they ask for and with
    ``page``; a block goes to the pages there are, whatever asks for it.
    """
    spread = rows.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1)))) if n_pages > 1 else \
        rows.withColumn("page", F.lit(0))
    keys = ["lane", "block", "page"]

    def run(page: pa.Table, block: pa.Table) -> pa.Table:
        return search(page, block)

    return queries.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(run, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}


def arrow_schema(columns: str) -> pa.Schema:
    """The Arrow schema of ``name type, ...``, for use inside workers."""
    fields = []
    for name, kind in (c.split() for c in columns.split(", ")):
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append((name, _ARROW[kind] if inner == kind else pa.list_(_ARROW[inner])))
    return pa.schema(fields)
