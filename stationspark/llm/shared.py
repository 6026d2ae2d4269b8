"""What several operators of this subpackage use."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.session import scratch_path

# The six ASCII white-space characters that separate words, and the rest.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written below the shared folder and read again.

    Cuts the lineage: whatever is lost later is read from the files, and
    non-repeatable parts (a shuffle's row order) are settled once.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where ``df`` has a column that is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` compressed to ``packed``, for the way through a
    shuffle: less than two thirds of what Spark's own compression leaves."""
    rest = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [packer.compress(t.as_buffer()) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({f.name: batch.column(f.name) for f in rest} | {
                "packed": pa.array(texts, pa.binary())})

    return rows.mapInArrow(run, T.StructType([*rest, T.StructField("packed", T.BinaryType())]))


def unpacked(column: pa.Array) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(p.as_buffer()) for p in column]


def workers_can_import(spark: SparkSession) -> None:
    """Puts the folder that holds this package on the path of Python workers.

    For sessions that were started from elsewhere on the same machine; on a
    cluster the package is shipped with the application (``--py-files``) or
    installed.
    """
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [home])
