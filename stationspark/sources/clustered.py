"""A layer clustered by station inside each month.

Rows are dealt to ranges of (month, station) and sorted in them, so a station's
rows of a month lie in one or a few neighbouring row groups of one or a few
files, and Parquet's min / max statistics let a station filter pass over the
others.  A Bloom filter on the station id serves the groups whose range holds
ids that are not in them.

A task that deals its rows to more ranges than Spark keeps open files for holds
them in memory until they are dealt, as many as its share of the input has.  So
the rows are first kept in files of ``ROWS_PER_FILE``, of which a task reads a
bounded number, however large the input and however well it is compressed.

The ranges end in a hash of the whole row: a month is cut into many ranges, a
station with a third of all rows as well, and no task holds a whole month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.session import scratch_path
from stationspark.sources.schemas import PARTITION_COLUMN

KEY = "WBAN"
#: Rows of a range, when the number of ranges is not given but the rows are.
ROWS_PER_RANGE = 2_000_000
ROW_GROUP_BYTES = 32 << 20
#: Rows of a file that is dealt to ranges.  A task reads less than
#: ``spark.sql.files.maxPartitionBytes / openCostInBytes`` files (32 by default).
ROWS_PER_FILE = 50_000


def ranges_for(n_rows: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    return max(1, -(-n_rows // rows_per_range))


def in_small_files(df: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` written below the shared folder and read again, a bounded number
    of rows in each task."""
    path = scratch_path(df.sparkSession, "unclustered")
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write(df: DataFrame, path: str, ranges: int, key: str = KEY, by=(PARTITION_COLUMN,),
          row_group_bytes: int = ROW_GROUP_BYTES, distinct_keys: int = 100_000) -> str:
    """Writes ``df`` clustered, replacing the months that it has.

    ``ranges``: tasks of the write; the rows of a month are spread over those
    ranges that it covers.  ``distinct_keys`` sizes the Bloom filters.
    """
    by = [c for c in by if c in df.columns]
    spread = F.xxhash64(*[c for c in df.columns if c not in (*by, key)])
    laid = in_small_files(df).repartitionByRange(ranges, *by, key, spread).sortWithinPartitions(*by, key)
    writer = (laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .option("parquet.block.size", row_group_bytes)
              .option(f"parquet.bloom.filter.enabled#{key}", "true")
              .option(f"parquet.bloom.filter.expected.ndv#{key}", distinct_keys))
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return path


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def of_station(df: DataFrame, wban: int, key: str = KEY) -> DataFrame:
    """A station's rows: the filter reaches the scan and its row groups."""
    return df.filter(F.col(key) == F.lit(int(wban)))
