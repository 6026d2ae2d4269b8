from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from stationspark.session import DEFAULT_CONF  # noqa: E402
from stationspark.sources import fixtures, schemas  # noqa: E402
from stationspark.sources.tables import WeatherTables  # noqa: E402

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def tables(spark) -> WeatherTables:
    return fixtures.load(spark, SF001)


@pytest.fixture
def make_tables(spark):
    """Build WeatherTables from small hand-made rows.

    ``station``: tuples (WBAN, State, Location, Latitude, Longitude).
    ``daily``: dicts with any of the daily columns plus ``month``.
    ``hourly``: tuples (WBAN, YearMonthDay, Time, DryBulbFarenheit, month).
    ``monthly``: tuples (WBAN, YearMonth, AvgTemp, month).
    """
    def build(station=(), daily=(), hourly=(), monthly=()):
        daily_schema = T.StructType(list(schemas.DAILY.fields) + [T.StructField("month", T.IntegerType())])
        daily_rows = [tuple(d.get(c) for c in daily_schema.fieldNames()) for d in daily]
        hourly_schema = T.StructType(list(schemas.HOURLY.fields) + [T.StructField("month", T.IntegerType())])
        hourly_rows = [(w, ymd, t, v, m) for (w, ymd, t, v, m) in hourly]
        monthly_schema = T.StructType(list(schemas.MONTHLY.fields) + [T.StructField("month", T.IntegerType())])
        return WeatherTables(
            station=spark.createDataFrame(list(station), schemas.STATION),
            daily=spark.createDataFrame(daily_rows, daily_schema),
            hourly=spark.createDataFrame(hourly_rows, hourly_schema),
            monthly=spark.createDataFrame(list(monthly), monthly_schema),
        )
    return build
