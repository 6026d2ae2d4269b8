"""Writers: the month-partitioned table layout and JSON records.

Writes are idempotent per month: with ``partitionOverwriteMode=dynamic`` an
overwrite replaces only the months present in the data, so a re-run after a
lost executor or a failed job converges to the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationspark.functions import clean
from stationspark.session import scratch_path
from stationspark.sources.catalog import METRICS
from stationspark.sources.readers import separator
from stationspark.sources.schemas import KINDS, PARTITION_COLUMN, SUSPECT_FLAGS, YEAR_COLUMN, key_columns


def _writer(df: DataFrame, partitioned: bool):
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partitioned and PARTITION_COLUMN in df.columns:
        w = w.partitionBy(PARTITION_COLUMN)
    return w


def write_parquet(df: DataFrame, path: str, partitioned: bool = True) -> str:
    _writer(df, partitioned).parquet(path)
    return path


def write_delimited(df: DataFrame, path: str, kind: str, partitioned: bool = True,
                    sep: str | None = None) -> str:
    """Header + delimited text.  Blanks are written as they are (no trimming):
    a blank weather code must not come back as a missing one."""
    (_writer(df, partitioned)
     .option("header", True).option("sep", sep or separator(kind))
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def write_month_files(df: DataFrame, root: str, kind: str, year: int = 2013) -> str:
    """The distributed layout ``{root}/{yyyymm}/{kind}.txt``: header + delimited
    text, one directory of part files per month present in ``df``.

    ``df`` is evaluated once, into a month-partitioned copy; each month is then
    written from its own partition.  Meant for exchanging data in the original
    layout, not for bulk loads.  Rows without a month have no file to go to:
    ``ValueError``.
    """
    staged = scratch_path(df.sparkSession, f"months-{kind}")
    write_parquet(df, staged)
    staged = df.sparkSession.read.schema(df.schema).parquet(staged)
    months = [r[0] for r in staged.select(PARTITION_COLUMN).distinct().collect()]    # at most 12 and null
    if None in months:
        raise ValueError(f"{kind} rows without a month")
    for m in sorted(months):
        one = staged.filter(F.col(PARTITION_COLUMN) == m).drop(PARTITION_COLUMN)
        write_delimited(one, f"{root.rstrip('/')}/{year}{m:02d}/{kind}.txt", kind, partitioned=False)
    return root


def clean_rows(df: DataFrame, kind: str) -> DataFrame:
    """Raw rows as the clean layer keeps them: the catalog's metrics as DOUBLE
    (markers and non-numbers null), other columns as they are, and for daily
    rows the number of values that carry the suspect flag, counted on the text.
    """
    if kind not in METRICS:
        return df
    value = clean.values_of(df)
    texts = clean.text_columns(df, exclude=key_columns(kind))
    columns = [value(c).alias(c) if c in METRICS[kind] and c in texts else F.col(c) for c in df.columns]
    if kind == "daily" and SUSPECT_FLAGS not in df.columns:
        columns.append(clean.flag_count(texts).alias(SUSPECT_FLAGS))
    return df.select(*columns)


def write_clean(tables, root: str, year: int = 2013) -> str:
    """The clean, typed layer ``{root}/{kind}/year=Y/month=M`` as Parquet.

    Readable by ``readers.load_partitioned``; the queries take it as they take
    raw tables, with numeric filters pushed to the scan.
    """
    root = root.rstrip("/")
    for kind in KINDS:
        df = getattr(tables, kind)
        if df is None:
            continue
        if PARTITION_COLUMN in df.columns:
            rows = clean_rows(df, kind).withColumn(YEAR_COLUMN, F.lit(year))
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(YEAR_COLUMN, PARTITION_COLUMN).parquet(f"{root}/{kind}"))
        else:
            write_parquet(df, f"{root}/{kind}", partitioned=False)
    return root


def write_tables(tables, root: str, fmt: str = "parquet") -> str:
    """Write every loaded table of ``tables`` below ``root/{kind}``."""
    root = root.rstrip("/")
    for kind in KINDS:
        df = getattr(tables, kind)
        if df is None:
            continue
        if fmt == "parquet":
            write_parquet(df, f"{root}/{kind}")
        else:
            write_delimited(df, f"{root}/{kind}", kind)
    return root


def records_json(df: DataFrame, column: str = "record") -> DataFrame:
    """Each row as one JSON object text, fields in column order, nulls kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(column))


def write_records(df: DataFrame, path: str) -> str:
    """Rows as JSON lines (one object per row), written by the executors."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path
