"""Checked loading: every line of the files is accepted or rejected, and counted.

A line is rejected when it has not as many values as the header, or when a key
(station, day, time; a station's coordinates may be missing) is absent or no
number.  Rejected lines keep their text, their file and the reason; nothing
becomes null in silence.

The files are read once.  One job writes both outputs, told apart by the
partition column ``accepted``, and the counters are observed on the way.
Blank lines are no lines, as for every reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.sources.readers import header_schema, month_of_path, separator
from stationspark.sources.schemas import KEYS, PARTITION_COLUMN, typed_columns

CORRUPT, REASON, RECORD, FILE, ACCEPTED = "_corrupt", "_reason", "_record", "_file", "accepted"
NOTES = (REASON, RECORD, FILE)


def _reason_of(name: str, kind: T.DataType) -> Column:
    text = F.col(name)
    return (F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.lit(f"{name} is missing"))
            .when(text.try_cast(kind).isNull(), F.concat(F.lit(f"{name} is no number: "), text)))


def read(spark: SparkSession, paths, kind: str, sep: str | None = None, month=None, names=None) -> DataFrame:
    """Typed keys and text columns of every line, with ``_reason`` (null where
    accepted), ``_record`` (the text of a rejected line), ``_file`` and ``month``.
    With ``names`` the files have no header line."""
    headed = names is None
    names = list(names or [f.name for f in header_schema(spark, paths, kind, sep).fields])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    rows = (spark.read.schema(schema).option("header", headed).option("sep", sep or separator(kind))
            .option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            # all values of a line count, whichever columns are asked for
            .option("columnPruning", False)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(paths))
    types = {n: t for n, t in typed_columns(kind).items() if n in names}
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of values"))]
    reasons += [_reason_of(n, types[n]) for n in KEYS[kind] if n in types]
    line = F.to_csv(F.struct(*names), {"sep": sep or separator(kind), "ignoreLeadingWhiteSpace": "false",
                                       "ignoreTrailingWhiteSpace": "false"})
    rows = rows.withColumns({REASON: F.coalesce(*reasons), FILE: F.col("_metadata.file_path"),
                             PARTITION_COLUMN: month_of_path(kind) if month is None else F.lit(month).cast("int")})
    rows = rows.withColumn(RECORD, F.when(F.col(REASON).isNotNull(), F.coalesce(F.col(CORRUPT), line)))
    values = [F.col(n).try_cast(types[n]).alias(n) if n in types else F.col(n) for n in names]
    return rows.select(*values, PARTITION_COLUMN, *NOTES)


def load(spark: SparkSession, paths, kind: str, root: str, sep: str | None = None, month=None,
         names=None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Accepted rows, rejected lines ``(_file, _reason, _record, month)``, and
    the counts ``lines``, ``accepted`` and ``rejected``; both tables below
    ``root`` (replaced)."""
    rows = read(spark, paths, kind, sep, month, names)
    schema, bad = rows.schema, F.col(REASON).isNotNull()
    counts = Observation(f"checked-{kind}")
    rows = rows.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(~bad).alias("accepted"),
                        F.count_if(bad).alias("rejected"))
    path = f"{root.rstrip('/')}/{kind}"
    rows.withColumn(ACCEPTED, ~bad).write.mode("overwrite").partitionBy(ACCEPTED, PARTITION_COLUMN).parquet(path)
    back = spark.read.schema(T.StructType([*schema.fields, T.StructField(ACCEPTED, T.BooleanType())])).parquet(path)
    accepted = back.filter(F.col(ACCEPTED)).drop(ACCEPTED, *NOTES)
    rejected = back.filter(~F.col(ACCEPTED)).select(FILE, REASON, RECORD, PARTITION_COLUMN)
    return accepted, rejected, dict(counts.get)


def reason_counts(rejected: DataFrame) -> DataFrame:
    """``(_file, reason, n)``: reasons without the values that they quote."""
    return rejected.groupBy(FILE, F.regexp_replace(REASON, ": .*$", "").alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))
