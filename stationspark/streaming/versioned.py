"""Ingest with corrections: the latest file wins for each key, history is kept.

A month may be delivered again, whole or in part, corrected.  Every row of
every file is kept below ``{root}/_history/{kind}`` with its file and the
file's modification time as version.  ``{root}/{kind}`` holds, for every key
(station, day and time), the rows of the latest file that has the key; the
queries read it like any other layer.  Maintained partials below
``{root}/_partials`` follow it month by month.

What a batch does is repeatable.  Its rows go to a partition of the history
named after the batch, which a second run of it replaces; the months that it
touched are then derived anew from their history and replaced as wholes.  So
a replayed batch changes nothing, and a file of an older version that comes
late adds the keys that no newer file has and changes no other.

Months are replaced by Spark's dynamic partition overwrite; a reader should
not scan a month while it is being replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationspark.operators import partials as pt
from stationspark.plans import maintained
from stationspark.sources.readers import header_schema, separator
from stationspark.sources.schemas import KEYS, PARTITION_COLUMN, YEAR_COLUMN

VERSION, FILE, BATCH = "_version", "_file", "_batch"
HISTORY_DIR = "_history"
MONTH_KEYS = [YEAR_COLUMN, PARTITION_COLUMN]


def history_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{HISTORY_DIR}/{kind}"


def current_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{kind}"


def delivered_glob(raw_root: str, kind: str) -> str:
    """``{yyyymm}*/{kind}.txt`` and ``{yyyymm}*/{kind}.*.txt``: a correction comes
    in a folder or under a name of its own, as a stream takes a path once."""
    return f"{raw_root.rstrip('/')}/*/{kind}{{,.*}}.txt"


def stamped(rows: DataFrame, kind: str) -> DataFrame:
    """Rows read from delivered files, with year, month, version and file."""
    path = F.col("_metadata.file_path")
    pattern = rf"/(\d{{4}})(\d{{2}})[^/]*/{re.escape(kind)}(?:\.[^/]*)?\.txt(?:/[^/]+)?$"
    part = lambda n: F.regexp_extract(path, pattern, n).try_cast(T.IntegerType())
    return rows.withColumns({
        VERSION: F.unix_micros(F.col("_metadata.file_modification_time")), FILE: path,
        YEAR_COLUMN: part(1), PARTITION_COLUMN: part(2)})


def _stamp() -> Column:
    return F.struct(VERSION, FILE)


def _in(months: list[tuple]) -> Column:
    """Partition filter: one of the months."""
    out = F.lit(False)
    for year, month in months:
        out = out | (F.col(YEAR_COLUMN).eqNullSafe(F.lit(year)) & F.col(PARTITION_COLUMN).eqNullSafe(F.lit(month)))
    return out


def latest_rows(rows: DataFrame, keys) -> DataFrame:
    """For each month and key the rows of the latest file that has the key.

    Versions order files, paths those of one version.  A file that repeats a
    key keeps its repetitions.  Rows with a null in the key cannot be told
    apart: of them those of the month's latest file stay.  A month of one
    file needs no comparison; where there are several, rows are shuffled by
    their keys, a handful to each.
    """
    per_month: dict[tuple, list] = {}
    for r in rows.groupBy(*MONTH_KEYS, VERSION, FILE).count().collect():  # a row for each file
        per_month.setdefault((r[YEAR_COLUMN], r[PARTITION_COLUMN]), []).append((r[VERSION], r[FILE]))
    single = [m for m, files in per_month.items() if len(files) == 1]
    several = [m for m, files in per_month.items() if len(files) > 1]
    whole = rows.filter(_in(single))
    if not several:
        return whole
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    own = rows.filter(_in(several))
    last = F.max(_stamp()).over(Window.partitionBy(*MONTH_KEYS, *keys))
    upserted = own.filter(keyed).withColumn("_last", last).filter(F.col("_last") == _stamp()).drop("_last")
    newest = F.lit(False)
    for month in several:
        version, file = max(per_month[month])
        newest = newest | (_in([month]) & (F.col(VERSION) == version) & (F.col(FILE) == file))
    return whole.unionByName(upserted).unionByName(own.filter(~keyed & newest))


def _replace_months(rows: DataFrame, path: str) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*MONTH_KEYS).parquet(path))


def read_history(spark: SparkSession, root: str, kind: str, schema: T.StructType) -> DataFrame:
    stamped_schema = T.StructType([
        *schema.fields, T.StructField(VERSION, T.LongType()), T.StructField(FILE, T.StringType()),
        T.StructField(YEAR_COLUMN, T.IntegerType()), T.StructField(PARTITION_COLUMN, T.IntegerType()),
        T.StructField(BATCH, T.StringType())])
    return spark.read.schema(stamped_schema).parquet(history_path(root, kind))


def apply_batch(rows: DataFrame, batch: str, root: str, kind: str, with_partials: bool = True) -> list[tuple]:
    """Adds stamped rows to the history as ``batch`` and brings the months that
    they touch up to date; the months."""
    spark = rows.sparkSession
    schema = T.StructType([f for f in rows.schema.fields if f.name not in (VERSION, FILE, *MONTH_KEYS)])
    (rows.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*MONTH_KEYS, BATCH).parquet(history_path(root, kind)))
    history = read_history(spark, root, kind, schema)
    touched = [tuple(r) for r in history.filter(F.col(BATCH) == batch).select(*MONTH_KEYS).distinct().collect()]
    if touched:
        current = latest_rows(history.filter(_in(touched)).drop(BATCH), KEYS[kind])
        _replace_months(current.drop(VERSION, FILE), current_path(root, kind))
        if with_partials and kind in pt.KINDS:
            now = spark.read.schema(T.StructType([*schema.fields, T.StructField(YEAR_COLUMN, T.IntegerType()),
                                                  T.StructField(PARTITION_COLUMN, T.IntegerType())]))
            rows = now.parquet(current_path(root, kind)).filter(_in(touched))
            maintained.write(pt.build(rows, kind), root, kind)
    return touched


def _reader(reader, kind: str, schema: T.StructType):
    return (reader.schema(schema).option("header", True).option("sep", separator(kind)).option("enforceSchema", False)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def restate(spark: SparkSession, paths: list[str], root: str, kind: str, schema: T.StructType,
            with_partials: bool = True) -> list[tuple]:
    """Files delivered again under their old paths, which a stream passes over.

    The batch is named after the files and their versions, so the same
    delivery restated twice is one batch.
    """
    rows = stamped(_reader(spark.read, kind, schema).csv(paths), kind)
    files = rows.select(VERSION, FILE).distinct().collect()      # a row for each file
    name = hashlib.sha256("\n".join(sorted(f"{f[VERSION]} {f[FILE]}" for f in files)).encode()).hexdigest()[:16]
    return apply_batch(rows, f"restated-{name}", root, kind, with_partials)


def start_ingest(spark: SparkSession, raw_root: str, kind: str, root: str, schema: T.StructType,
                 checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                 with_partials: bool = True, available_now: bool = True) -> StreamingQuery:
    """The stream of one kind's files into the versioned layer."""
    reader = _reader(spark.readStream, kind, schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = stamped(reader.csv(delivered_glob(raw_root, kind)), kind)
    writer = (stream.writeStream.foreachBatch(_batch(root, kind, with_partials))
              .option("checkpointLocation", checkpoint or f"{root.rstrip('/')}/_checkpoints/versioned-{kind}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _batch(root: str, kind: str, with_partials: bool) -> Callable[[DataFrame, int], None]:
    def run(rows: DataFrame, batch_id: int) -> None:
        apply_batch(rows, f"{batch_id:09d}", root, kind, with_partials)

    return run


def ingest_available(spark: SparkSession, raw_root: str, root: str, layouts: dict | None = None, kinds=tuple(KEYS),
                     **options) -> None:
    """Every file not yet taken, of each kind that has one, and wait."""
    for kind in kinds if layouts is None else layouts:
        try:
            schema = layouts[kind] if layouts else header_schema(spark, delivered_glob(raw_root, kind), kind)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue                                             # no file of this kind yet
        query = start_ingest(spark, raw_root, kind, root, schema, **options)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
