"""Incremental ingest of arriving month files into the partitioned Parquet layer.

Station data arrive as one text file per month and record kind
(``{raw_root}/{yyyymm}/{kind}.txt``).  A Structured Streaming file source
picks up every file not yet seen, the sink appends it to
``{out_root}/{kind}/year=Y/month=M/`` and the checkpoint records what was done, so
a re-run (after a failure, a lost executor or a new month) processes only
new files and never duplicates rows.  ``availableNow`` runs the backlog as a
bounded batch job and stops, which suits a scheduled ingest.

The queries then read the output with
:func:`stationspark.sources.readers.load_partitioned`: explicit types, a
columnar format and month partition pruning instead of re-parsing text.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationspark.sources.readers import header_schema, month_of_path, separator, year_of_path
from stationspark.sources.schemas import KINDS, PARTITION_COLUMN, YEAR_COLUMN


def month_file_stream(spark: SparkSession, raw_root: str, kind: str,
                      schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over ``{raw_root}/*/{kind}.txt`` with ``year`` and ``month`` columns.

    A streaming file source needs its schema up front (no inference); keys
    may be typed (``03011`` parses as 3011), metrics stay text.
    """
    reader = (spark.readStream.schema(schema)
              .option("header", True).option("sep", separator(kind))
              # a file whose header differs from the schema fails; by position
              # its values would land in the wrong columns
              .option("enforceSchema", False)
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(f"{raw_root.rstrip('/')}/*/{kind}.txt")
    return rows.withColumns({YEAR_COLUMN: year_of_path(kind), PARTITION_COLUMN: month_of_path(kind)})


def default_checkpoint(out_root: str, kind: str) -> str:
    """Checkpoint beside the output table it belongs to: removing the output
    removes its progress too, and no two outputs can share one."""
    return f"{out_root.rstrip('/')}/_checkpoints/{kind}"


def start_ingest(spark: SparkSession, raw_root: str, kind: str, out_root: str,
                 schema: T.StructType, checkpoint: str | None = None,
                 available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest of one record kind; returns the running query."""
    stream = month_file_stream(spark, raw_root, kind, schema, max_files_per_trigger)
    writer = (stream.writeStream.format("parquet")
              .partitionBy(YEAR_COLUMN, PARTITION_COLUMN)
              .option("checkpointLocation", checkpoint or default_checkpoint(out_root, kind))
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(f"{out_root.rstrip('/')}/{kind}")


def ingest_available(spark: SparkSession, raw_root: str, out_root: str,
                     layouts: dict | None = None,
                     checkpoint_root: str | None = None) -> dict[str, int]:
    """Ingest every new file of each kind and wait; rows processed per kind.

    ``layouts`` maps kind -> schema.  Without it every kind with at least one
    file is ingested, its schema taken from a header (see ``header_schema``).
    """
    if layouts is None:
        layouts = {}
        for kind in KINDS:
            try:
                layouts[kind] = header_schema(spark, f"{raw_root.rstrip('/')}/*/{kind}.txt", kind)
            except AnalysisException:      # no file of this kind yet
                continue
    done = {}
    for kind, schema in layouts.items():
        ckpt = f"{checkpoint_root.rstrip('/')}/{kind}" if checkpoint_root else None
        # availableNow takes every new file in one batch here (no file limit),
        # so the last progress reports are never cut off
        query = start_ingest(spark, raw_root, kind, out_root, schema, checkpoint=ckpt)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        done[kind] = sum(p.get("numInputRows", 0) for p in query.recentProgress)
    return done
