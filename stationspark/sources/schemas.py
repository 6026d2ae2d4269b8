"""Raw-layer schemas and key columns per record kind.

Raw layer: keys are typed, every metric, flag and code column is STRING
(the files mix numbers with the markers ``M``, ``T`` and ``s``).  Numbers
are produced later, per query, by :func:`stationspark.functions.clean.metric`.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Kinds stored as one table each, partitioned by ``month``.
FACT_KINDS = ("daily", "hourly", "monthly", "precip", "remarks")
KINDS = FACT_KINDS + ("station",)

# Key columns: typed INT in the raw layer and never treated as metric or flag.
KEYS = {
    "daily": ("WBAN", "YearMonthDay"),
    "hourly": ("WBAN", "YearMonthDay", "Time"),
    "monthly": ("WBAN", "YearMonth"),
    "precip": ("WBAN", "YearMonthDay"),
    "remarks": ("WBAN", "YearMonthDay", "Time"),
    "station": ("WBAN",),
}

# Station columns that are not text.
STATION_TYPES = {"WBAN": T.IntegerType(), "Latitude": T.DoubleType(),
                 "Longitude": T.DoubleType()}

PARTITION_COLUMN = "month"
YEAR_COLUMN = "year"

# Clean layer: per daily row, how many values carry the suspect flag.
SUSPECT_FLAGS = "suspect_flags"

STATION = T.StructType([
    T.StructField("WBAN", T.IntegerType()),
    T.StructField("State", T.StringType()),
    T.StructField("Location", T.StringType()),
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
])


def _strings(names):
    return [T.StructField(n, T.StringType()) for n in names]


def _ints(names):
    return [T.StructField(n, T.IntegerType()) for n in names]


# Column layouts of the weather views built over the driver tables (and of the
# CSV files the tests write from them).  Month is the partition column and is
# not stored inside the files.
DAILY = T.StructType(_ints(KEYS["daily"]) + _strings([
    "Tavg", "TavgFlag", "Depart", "DewPoint", "DewPointFlag", "WetBulb",
    "CodeSum", "PrecipTotal", "Max5Speed"]))

HOURLY = T.StructType(_ints(KEYS["hourly"]) + _strings(["DryBulbFarenheit"]))

MONTHLY = T.StructType(_ints(KEYS["monthly"]) + _strings(["AvgTemp"]))

LAYOUTS = {"daily": DAILY, "hourly": HOURLY, "monthly": MONTHLY, "station": STATION}


def by_month(layout: T.StructType) -> T.StructType:
    """A layout with its partition column, as a partitioned table is read."""
    return T.StructType([*layout.fields, T.StructField(PARTITION_COLUMN, T.IntegerType())])


def key_columns(kind: str) -> tuple[str, ...]:
    return KEYS[kind] + ((YEAR_COLUMN, PARTITION_COLUMN) if kind in FACT_KINDS else ())


def typed_columns(kind: str) -> dict:
    """Columns with a non-text type in the raw layer of ``kind``."""
    if kind == "station":
        return dict(STATION_TYPES)
    return {k: T.IntegerType() for k in KEYS[kind]}
