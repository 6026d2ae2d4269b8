"""Month files whose headers differ, one scan for each distinct header.

Deliveries order their columns in a few ways, not in one for each file.  The
headers are read first (the first line of each file, no Spark job), files are
grouped by them, and every group is one scan with its own schema; the groups
are united by column name.  k headers are k scans, however many months there
are, and every file is read once.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stationspark.sources import files
from stationspark.sources.readers import (
    month_file_paths,
    month_of_path,
    read_delimited,
    separator,
    union_months,
    year_of_path,
)
from stationspark.sources.schemas import PARTITION_COLUMN, YEAR_COLUMN, typed_columns


def header(spark: SparkSession, path: str, sep: str) -> tuple[str, ...]:
    line = files.first_line(spark, path)
    return tuple(next(csv.reader(io.StringIO(line or ""), delimiter=sep), ()))


def groups(spark: SparkSession, paths, kind: str, sep: str | None = None) -> dict[tuple[str, ...], list[str]]:
    """Files by header; empty files have none and are left out."""
    out: dict[tuple[str, ...], list[str]] = {}
    for path in files.matching(spark, paths):
        names = header(spark, path, sep or separator(kind))
        if names:
            out.setdefault(names, []).append(path)
    return out


def read(spark: SparkSession, paths, kind: str, sep: str | None = None) -> DataFrame:
    """All files, whatever the order of their columns, with ``year`` and ``month``.

    The headers must name the same set of columns (``ValueError`` otherwise).
    """
    by_header = groups(spark, paths, kind, sep)
    if not by_header:
        raise ValueError(f"no {kind} file with a header in {paths}")
    typed = typed_columns(kind)
    frames = []
    for names, of in by_header.items():
        schema = T.StructType([T.StructField(n, typed.get(n, T.StringType())) for n in names])
        rows = read_delimited(spark, of, kind, sep, schema)
        frames.append(rows.withColumns({YEAR_COLUMN: year_of_path(kind), PARTITION_COLUMN: month_of_path(kind)}))
    return union_months(frames)


def read_month_files(spark: SparkSession, root: str, kind: str, months=None, year: int = 2013) -> DataFrame:
    """``{root}/{yyyymm}/{kind}.txt`` of the chosen months, by header group."""
    return read(spark, month_file_paths(root, kind, months, year), kind).drop(YEAR_COLUMN)
