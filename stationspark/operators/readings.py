"""Readings delivered more than once count once, in batch and in a stream.

A reading is known by its key (station, day, time).  In batch, rows of one key
are reduced by an aggregation, so copies are combined in the tasks that read
them and a reading repeated a million times is one row from each task.  In a
stream, the keys seen are state that a watermark on the reading's own time
clears.  Rows without a whole key cannot be told apart and are all kept.

Both keep one row of a key.  Copies are alike; where deliveries of one key
differ, batch keeps the least row (by its columns in order) and a stream the
one that came first.  Corrections are another matter: see
:mod:`stationspark.streaming.versioned`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationspark.sources.schemas import KEYS, PARTITION_COLUMN, YEAR_COLUMN
from stationspark.streaming.ingest import default_checkpoint, month_file_stream

READ_AT = "_read_at"


def read_at(kind: str) -> Column:
    """When a reading was taken: its day (or month's first day) and clock time."""
    ymd = F.col("YearMonth") * 100 + 1 if "YearMonth" in KEYS[kind] else F.col("YearMonthDay")
    day = F.try_to_timestamp(ymd.cast("string"), F.lit("yyyyMMdd"))
    if "Time" not in KEYS[kind]:
        return day
    minutes = F.floor(F.col("Time") / 100) * 60 + F.col("Time") % 100
    return F.timestamp_seconds(F.unix_timestamp(day) + F.coalesce(minutes, F.lit(0)) * 60)


def _whole(keys, *more: str) -> Column:
    out = F.lit(True)
    for key in (*keys, *more):
        out = out & F.col(key).isNotNull()
    return out


def distinct_readings(fact: DataFrame, kind: str) -> DataFrame:
    """One row of each key, whichever months' files it came in."""
    keys = KEYS[kind]
    rest = [c for c in fact.columns if c not in keys]
    whole = fact.filter(_whole(keys))
    if rest:
        least = F.min(F.struct(*rest)).alias("_row")
        once = whole.groupBy(*keys).agg(least).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    else:
        once = whole.distinct()
    return once.unionByName(fact.filter(~_whole(keys))).select(*fact.columns)


def duplicate_counts(fact: DataFrame, kind: str) -> DataFrame:
    """``(*keys, n)`` of every reading that is there more than once."""
    keys = KEYS[kind]
    return fact.filter(_whole(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def distinct_stream(stream: DataFrame, kind: str, delay: str = "62 days") -> DataFrame:
    """A stream's readings once each, as far as copies come within ``delay`` of
    the latest reading's time; rows without a whole key or day pass."""
    keys = KEYS[kind]
    timed = stream.withColumn(READ_AT, read_at(kind))
    whole = timed.filter(_whole(keys, READ_AT)).withWatermark(READ_AT, delay)
    once = whole.dropDuplicatesWithinWatermark(list(keys))
    return once.drop(READ_AT).unionByName(timed.filter(~_whole(keys, READ_AT)).drop(READ_AT))


def start_distinct_ingest(spark: SparkSession, raw_root: str, kind: str, root: str, schema: T.StructType,
                          delay: str = "62 days", checkpoint: str | None = None,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """The ingest of month files with readings once each; appends to ``{root}/{kind}``."""
    stream = distinct_stream(month_file_stream(spark, raw_root, kind, schema, max_files_per_trigger), kind, delay)
    return (stream.writeStream.format("parquet").partitionBy(YEAR_COLUMN, PARTITION_COLUMN)
            .option("checkpointLocation", checkpoint or default_checkpoint(root, kind))
            .outputMode("append").trigger(availableNow=True).start(f"{root.rstrip('/')}/{kind}"))
