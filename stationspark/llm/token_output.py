"""Token ids written as shuffled byte or bit planes, and read back.

Documents are dealt to ranges of ascending id; a task encodes its range and
fills chunks.  A chunk holds whole documents, in order, until it has
``CHUNK_IDS`` ids; a longer document is a chunk of its own.  A chunk's ids
are cut into blocks of ``BLOCK_IDS`` (the last one shorter); each block is
transposed, so that equal-ranking bytes (or bits) of all its ids lie together
as one plane, and every plane is compressed with zstandard by itself.

The file format is two tables below one path, written by Spark (whole files
are committed or none, so lost tasks are simply run again):

* ``chunks``: ``part`` (the range, ascending), ``chunk`` (in the range),
  ``n_ids``, ``kind`` of planes, ``doc_ids`` and ``n_tokens`` of its
  documents, ``planes`` (block by block, plane by plane, low plane first);
* ``index``: for each chunk ``start`` (ids of all chunks before it), its
  number of ids and documents and its first and last document.

Defined results: a null text counts as empty, which is one id (the end id);
a null document id comes first; rows with one id follow each other in the
order of their texts; an empty table gives empty files; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationspark.llm.shared import whole_text
from stationspark.llm.tokens import encoder
from stationspark.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
#: Written after each document.
END_ID = 0
BLOCK_IDS = 65_536
CHUNK_IDS = 1 << 20
LEVEL = 3

CHUNKS = ("part int, chunk int, n_ids long, kind string, doc_ids array<long>, "
          "n_tokens array<long>, planes array<binary>")
DOCUMENTS = "part int, chunk int, doc_id long, before long, n_tokens long, ids_crc32 long"


def to_planes(ids: bytes, kind: str) -> list[bytes]:
    """The planes of one block of 32-bit ids."""
    table = np.frombuffer(ids, dtype=np.uint8).reshape(-1, 4)
    if kind == "bit":
        bits = np.unpackbits(table, axis=1, bitorder="little")
        return [np.packbits(row, bitorder="little").tobytes() for row in bits.T]
    return [row.tobytes() for row in np.ascontiguousarray(table.T)]


def from_planes(planes: list[bytes], n: int, kind: str) -> bytes:
    rows = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes])
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, count=n, bitorder="little")
        return np.packbits(bits.T, axis=1, bitorder="little").tobytes()
    return np.ascontiguousarray(rows.T).tobytes()


def _filled_chunks(tokenizer: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own, packer = encoder(tokenizer), zstandard.ZstdCompressor(level=LEVEL)
        schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()),
                            ("kind", pa.string()), ("doc_ids", pa.list_(pa.int64())),
                            ("n_tokens", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary()))])
        doc_ids, texts, held, chunk = [], [], 0, 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(texts).tobytes()
            planes = [packer.compress(p) for i in range(0, len(ids), 4 * BLOCK_IDS)
                      for p in to_planes(ids[i:i + 4 * BLOCK_IDS], kind)]
            values = [part, chunk, len(ids) // 4, kind, doc_ids, [len(t) for t in texts], planes]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)],
                                              schema=schema)

        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for at, ids, ends in own.encoded(batch.column(1), END_ID):
                for doc_id, start, end in zip(numbers[at:], [0, *ends], ends):
                    if held and held + end - start > CHUNK_IDS:
                        yield closed()
                        doc_ids, texts, held, chunk = [], [], 0, chunk + 1
                    doc_ids.append(doc_id)
                    texts.append(ids[start:end])
                    held += end - start
        if texts:
            yield closed()

    return run


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, kind: str = "byte") -> str:
    """Both tables below ``path``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_filled_chunks(tokenizer, kind), CHUNKS).write.parquet(f"{path}/chunks", compression="none")
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").select(
        "part", "chunk", "n_ids", F.size("doc_ids").alias("n_docs"), F.get("doc_ids", F.lit(0)).alias("first_doc"),
        F.element_at("doc_ids", -1).alias("last_doc"))
    # one row for each range: as many as the write had tasks
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    inside = Window.partitionBy("part").orderBy("chunk")
    index = chunks.join(before, "part").withColumn(
        "start", F.col("before") + F.sum("n_ids").over(inside) - F.col("n_ids")).drop("before")
    index.write.parquet(f"{path}/index")
    return path


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(part, chunk, doc_ids, n_tokens, ids)`` of each chunk."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            blocks, per = [], 8 * 4 if row["kind"] == "bit" else 4
            for k in range(0, len(row["planes"]), per):
                n = min(BLOCK_IDS, row["n_ids"] - k // per * BLOCK_IDS)
                blocks.append(from_planes([unpacker.decompress(p) for p in row["planes"][k:k + per]],
                                          n, row["kind"]))
            yield row["part"], row["chunk"], row["doc_ids"], row["n_tokens"], b"".join(blocks)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, chunk, doc_ids, n_tokens, ids in _decoded(batches):
        sizes = np.array(n_tokens, dtype=np.int64)
        before = np.cumsum(sizes) - sizes
        crc = [zlib.crc32(ids[4 * a:4 * (a + n)]) for a, n in zip(before.tolist(), n_tokens)]
        n = len(doc_ids)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * n, pa.int32()), "chunk": pa.array([chunk] * n, pa.int32()),
            "doc_id": pa.array(doc_ids, pa.int64()), "before": pa.array(before),
            "n_tokens": pa.array(sizes), "ids_crc32": pa.array(crc, pa.int64())})


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, doc_ids, n_tokens, ids in _decoded(batches):
        ends = 4 * np.cumsum(n_tokens)
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(doc_ids, pa.int64()),
            "ids": pa.array([np.frombuffer(ids[e - 4 * n:e], dtype="<u4").astype(np.int64)
                             for e, n in zip(ends.tolist(), n_tokens)], pa.list_(pa.int64()))})


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, ids)`` from the files."""
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    return chunks.mapInArrow(_documents, "doc_id long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files."""
    docs = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").mapInArrow(_digests, DOCUMENTS)
    index = spark.read.parquet(f"{path}/index").select("part", "chunk", "start")
    return docs.join(index, ["part", "chunk"]).select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str = TOKENIZER, kind: str = "byte") -> DataFrame:
    """What the files say of each document after writing and reading them."""
    path = write(docs, scratch_path(docs.sparkSession, "token-planes"), tokenizer, kind)
    return read_digests(docs.sparkSession, path)
