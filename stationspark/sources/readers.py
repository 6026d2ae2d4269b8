"""Readers for month-partitioned station data (delimited text or Parquet).

Two on-disk layouts are supported:

* partitioned: ``{root}/{kind}/month={m}/...`` (Hive style).  A filter on
  ``month`` becomes a ``PartitionFilters`` entry and unread months are never
  listed or opened.
* per-month files: ``{root}/{yyyymm}/{kind}.txt`` (one file per month and
  kind, as the station product is distributed).  The months asked for
  select the paths; all of them are read in one scan and ``month`` is taken
  from the file path.

No reader infers a schema: either an explicit ``StructType`` is given, or
column names come from the header and every column is text, with the key
columns cast afterwards.  Inference would cost a full extra pass per file.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.operators.stations import latest_station_rows
from stationspark.sources.schemas import PARTITION_COLUMN, YEAR_COLUMN, typed_columns
from stationspark.sources.tables import WeatherTables

COMMA = ","
PIPE = "|"


def separator(kind: str) -> str:
    """Station files are pipe-separated; all other kinds are comma-separated."""
    return PIPE if kind == "station" else COMMA


def _text_reader(spark: SparkSession, sep: str):
    # Blanks are data (a blank weather code is not a missing one): keep them.
    # Every file's header is checked against the schema (``enforceSchema``
    # off): a file with another column order fails instead of being read
    # by position into the wrong columns.
    return (spark.read.option("header", True).option("sep", sep)
            .option("enforceSchema", False)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("mode", "PERMISSIVE"))


def type_keys(df: DataFrame, kind: str) -> DataFrame:
    """Cast the typed columns of ``kind`` (keys, station coordinates) from text.

    ``try_cast`` keeps a malformed key from failing the job (it becomes null);
    ``03011`` becomes 3011, as on both sides of every join.
    """
    casts = {c: F.col(c).try_cast(t) for c, t in typed_columns(kind).items()
             if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    return df.withColumns(casts) if casts else df


def read_delimited(spark: SparkSession, paths, kind: str, sep: str | None = None,
                   schema: T.StructType | None = None) -> DataFrame:
    """Header-carrying delimited text of one record kind.

    With ``schema`` the header is checked against it (``enforceSchema`` off);
    without, names come from the header and all columns are read as text.
    """
    reader = _text_reader(spark, sep or separator(kind))
    if schema is not None:
        return reader.schema(schema).csv(paths)
    return type_keys(reader.csv(paths), kind)


def header_schema(spark: SparkSession, paths, kind: str, sep: str | None = None) -> T.StructType:
    """Schema from a header line: its names, keys typed, every other column text.

    Only the header is read (no inference pass); needed where a schema must
    be given up front, as for a streaming file source.
    """
    names = _text_reader(spark, sep or separator(kind)).csv(paths).columns
    typed = typed_columns(kind)
    return T.StructType([T.StructField(n, typed.get(n, T.StringType())) for n in names])


def read_partitioned(spark: SparkSession, root: str, kind: str, fmt: str = "parquet",
                     schema: T.StructType | None = None) -> DataFrame:
    """The ``{root}/{kind}`` table with its ``month`` partition column."""
    path = f"{root.rstrip('/')}/{kind}"
    if fmt == "parquet":
        # with a schema no footer is read while planning
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return read_delimited(spark, path, kind, schema=schema)


def read_month(spark: SparkSession, root: str, kind: str, month: int,
               fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """One month directory of a partitioned table, ``month`` added as a literal."""
    path = f"{root.rstrip('/')}/{kind}/{PARTITION_COLUMN}={month}"
    df = ((spark.read.schema(schema) if schema else spark.read).parquet(path) if fmt == "parquet"
          else read_delimited(spark, path, kind, schema=schema))
    return df.withColumn(PARTITION_COLUMN, F.lit(month).cast(T.IntegerType()))


def union_months(frames: list[DataFrame]) -> DataFrame:
    """Concatenate per-month frames by column name, duplicates kept.

    All frames must have the same set of columns (order may differ);
    otherwise ``ValueError``.
    """
    if not frames:
        raise ValueError("no month to union")
    names = set(frames[0].columns)
    for i, df in enumerate(frames[1:], start=1):
        if set(df.columns) != names:
            raise ValueError(f"columns of frame {i} differ from frame 0: "
                             f"{sorted(set(df.columns) ^ names)}")
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def month_file_paths(root: str, kind: str, months=None, year: int = 2013) -> list[str]:
    """Paths of the chosen months, or one glob over every month present."""
    if months is None:
        return [f"{root.rstrip('/')}/{year}[01][0-9]/{kind}.txt"]
    return [f"{root.rstrip('/')}/{year}{m:02d}/{kind}.txt" for m in months]


def month_of_path(kind: str):
    """``month`` from the path of a ``{yyyymm}/{kind}.txt`` file (or of a part
    file inside a ``{kind}.txt`` directory written by Spark); null otherwise."""
    return _of_path(kind, 2)


def year_of_path(kind: str):
    """``year`` from the path, like ``month_of_path``."""
    return _of_path(kind, 1)


def _of_path(kind: str, group: int):
    pattern = rf"/(\d{{4}})(\d{{2}})/{re.escape(kind)}\.txt(?:/[^/]+)?$"
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group).try_cast(T.IntegerType())


def read_month_files(spark: SparkSession, root: str, kind: str, months=None,
                     year: int = 2013, schema: T.StructType | None = None,
                     by_name: bool = False) -> DataFrame:
    """Per-month files ``{root}/{yyyymm}/{kind}.txt`` (all months present when
    ``months`` is None).

    Default: one scan of all files, whose headers must all match.  With
    ``by_name`` (months whose files order their columns differently) each
    month is read on its own and the months are unioned by column name; every
    file is still read once.
    """
    if by_name:
        if months is None:
            raise ValueError("by_name needs the list of months")
        frames = [read_delimited(spark, month_file_paths(root, kind, [m], year), kind, schema=schema)
                  .withColumn(PARTITION_COLUMN, F.lit(m).cast(T.IntegerType())) for m in months]
        return union_months(frames)
    paths = month_file_paths(root, kind, months, year)
    df = read_delimited(spark, paths, kind, schema=schema)
    return df.withColumn(PARTITION_COLUMN, month_of_path(kind))


FACTS = ("daily", "hourly", "monthly")


# Months whose station file gives the dimension, unless the caller says otherwise.
STATION_MONTHS = (1,)


def load_month_files(spark: SparkSession, root: str, months=None, year: int = 2013,
                     station_months=STATION_MONTHS, kinds=FACTS, by_name: bool = False) -> WeatherTables:
    """Tables over per-month files.  The station dimension keeps one row per
    WBAN, the one of the latest month in ``station_months`` (None: all months).
    ``kinds`` chooses the fact tables to read (``precip``, ``remarks`` too);
    ``by_name`` aligns months whose files order their columns differently."""
    station = read_month_files(spark, root, "station", station_months, year, by_name=by_name)
    facts = {k: read_month_files(spark, root, k, months, year, by_name=by_name) for k in kinds}
    return WeatherTables(station=latest_station_rows(station), **facts)


def load_partitioned(spark: SparkSession, root: str, fmt: str = "parquet", year: int = 2013,
                     station_months=STATION_MONTHS, kinds=None, schemas: dict | None = None) -> WeatherTables:
    """Tables over the partitioned layout written by :mod:`stationspark.sources.sinks`
    or by the streaming ingest.

    Gives what :func:`load_month_files` gives over the files that were
    ingested: one ``year`` (where the layer keeps years), and a station
    dimension of one row per WBAN from ``station_months`` (None: all; no
    effect where the station table is kept without months).  ``kinds=None``
    loads every fact table that the layer has.  ``schemas``: kind -> columns
    with the partition columns, so that no footer is read while planning.
    """
    schemas = schemas or {}
    station = _of_year(read_partitioned(spark, root, "station", fmt, schemas.get("station")), year)
    if PARTITION_COLUMN in station.columns and station_months is not None:
        station = station.filter(F.col(PARTITION_COLUMN).isin(list(station_months)))
    facts = {}
    for kind in kinds if kinds is not None else FACTS:
        try:
            facts[kind] = _of_year(read_partitioned(spark, root, kind, fmt, schemas.get(kind)), year)
        except AnalysisException as missing:
            # a layer may lack a kind; a kind asked for by name must be there
            if kinds is not None or missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return WeatherTables(station=latest_station_rows(station), **facts)


def _of_year(df: DataFrame, year: int) -> DataFrame:
    return df.filter(F.col(YEAR_COLUMN) == F.lit(year)).drop(YEAR_COLUMN) if YEAR_COLUMN in df.columns else df
