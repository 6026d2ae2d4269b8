"""Weather-shaped views over the driver's TPC-H-like tables.

The library's queries run over four tables: ``station`` (dimension) and the
facts ``daily``, ``hourly`` and ``monthly``.  For tests and benchmarks these
are derived, row for row, from the driver tables:

* station  <- supplier JOIN nation
* daily    <- lineitem
* hourly   <- events
* monthly  <- orders

The derivations are plain column expressions, so Catalyst prunes every
unused source column and the scans read only what a query needs.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.sources.tables import WeatherTables


def _ymd(ts: str) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast(T.IntegerType())


def _text(c: Column) -> Column:
    return c.cast(T.StringType())


def _unless(cond: Column, marker: str, value: Column) -> Column:
    return F.when(cond, F.lit(marker)).otherwise(_text(value))


def station_view(supplier, nation):
    return (supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
            .select(F.col("s_suppkey").cast(T.IntegerType()).alias("WBAN"),
                    F.col("n_name").alias("State"),
                    F.col("s_name").alias("Location"),
                    (F.lit(25) + F.col("s_suppkey") % 24).cast(T.DoubleType()).alias("Latitude"),
                    (F.lit(-70) - F.col("s_suppkey") % 50).cast(T.DoubleType()).alias("Longitude")))


def station_versions_view(supplier, nation):
    """Monthly versions of the stations (fixture rule): most are known from
    January on, every fifth from March on; every fourth moves to the next
    nation later in the year."""
    key = F.col("s_suppkey")
    since = F.when(key % 5 == 1, 3).otherwise(1)
    first = F.struct(since.alias("month"), F.col("s_nationkey").alias("n"), F.col("s_name").alias("Location"))
    moved = F.struct((key % 9 + 4).cast("int").alias("month"), ((F.col("s_nationkey") + 1) % 25).alias("n"),
                     F.concat("s_name", F.lit(" moved")).alias("Location"))
    versions = F.when(key % 4 == 0, F.array(first, moved)).otherwise(F.array(first))
    rows = supplier.select(key.cast(T.IntegerType()).alias("WBAN"), F.inline(versions))
    return rows.join(nation, rows["n"] == nation["n_nationkey"]).select(
        "WBAN", F.col("month").cast(T.IntegerType()).alias("month"), F.col("n_name").alias("State"), "Location")


# Precipitation text by discount in hundredths (fixture rule).
_PRECIP_BY_DISCOUNT = {0: "0.00", 1: "  T", 2: "M", 3: "0.00", 4: "1.00",
                       5: "1.25", 6: "1.50", 7: "0.75"}


def daily_view(lineitem):
    qty = F.col("l_quantity").cast(T.IntegerType())
    okey, pkey, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    disc = F.round(F.col("l_discount") * 100).cast(T.IntegerType())
    precip = F.lit("2.50")
    for cents, text in _PRECIP_BY_DISCOUNT.items():
        precip = F.when(disc == cents, F.lit(text)).otherwise(precip)
    code = (F.when(line == 1, F.lit("TSRA")).when(line == 2, F.lit("RA"))
            .when(line == 3, F.lit("BR TS")).when(line == 4, F.lit(None).cast("string"))
            .otherwise(F.lit(" ")))
    return lineitem.select(
        F.col("l_suppkey").cast(T.IntegerType()).alias("WBAN"),
        _ymd("l_shipdate").alias("YearMonthDay"),
        _unless(okey % 17 == 0, "M", qty + 40).alias("Tavg"),
        F.when(okey % 29 == 0, F.lit("s")).otherwise(F.lit(" ")).alias("TavgFlag"),
        _unless(okey % 13 == 0, "M", qty - 25).alias("Depart"),
        _unless(pkey % 19 == 0, "M", F.lit(30) + pkey % 45).alias("DewPoint"),
        F.when(pkey % 31 == 0, F.lit("s")).otherwise(F.lit(" ")).alias("DewPointFlag"),
        _unless(pkey % 7 == 0, "M", F.lit(35) + pkey % 40).alias("WetBulb"),
        code.alias("CodeSum"),
        precip.alias("PrecipTotal"),
        _unless(pkey % 23 == 0, "M", line * 5).alias("Max5Speed"),
        F.month("l_shipdate").cast(T.IntegerType()).alias("month"),
    )


def hourly_view(events):
    eid = F.col("event_id")
    dry = (F.when(eid % 11 == 0, F.lit("M")).when(eid % 37 == 0, F.lit("  T"))
           .otherwise(_text((eid % 90).cast(T.IntegerType()) + 10)))
    # the events lie in January: each is a reading then, and one more in another month
    month = F.explode(F.array(F.month("ts"), (F.pmod(F.floor(eid / 11), F.lit(11)) + 2).cast(T.IntegerType()))).alias("month")
    events = events.select("event_id", "user_id", "ts", month)
    day = F.when(F.col("month") == F.month("ts"), F.dayofmonth("ts")).otherwise(F.least(F.dayofmonth("ts"), F.lit(28)))
    return events.select(
        F.col("user_id").cast(T.IntegerType()).alias("WBAN"),
        (F.year("ts") * 10000 + F.col("month") * 100 + day).cast(T.IntegerType()).alias("YearMonthDay"),
        (F.hour("ts") * 100 + F.minute("ts")).cast(T.IntegerType()).alias("Time"),
        dry.alias("DryBulbFarenheit"),
        F.col("month").cast(T.IntegerType()).alias("month"),
    )


def monthly_view(orders):
    okey = F.col("o_orderkey")
    return orders.select(
        (F.col("o_custkey") % 120).cast(T.IntegerType()).alias("WBAN"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast(T.IntegerType()).alias("YearMonth"),
        _unless(okey % 31 == 0, "M", (F.lit(20) + okey % 70).cast(T.IntegerType())).alias("AvgTemp"),
        F.month("o_orderdate").cast(T.IntegerType()).alias("month"),
    )


# Physical schemas of the driver tables the views read.  Declaring them skips
# the footer-reading job Spark runs to infer a Parquet schema on every read.
SOURCE_SCHEMAS = {
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
               "value DOUBLE, props STRING"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
}


# Views already built, per session and directory.  A view is an
# immutable logical plan, so one instance serves every query of a session;
# building it again would only repeat the Python-to-JVM calls that assemble it.
_loaded: weakref.WeakKeyDictionary[SparkSession, dict[str, WeatherTables]] = weakref.WeakKeyDictionary()


def load(spark: SparkSession, sf_dir: str) -> WeatherTables:
    """Weather tables over ``{sf_dir}/{table}.parquet``."""
    sf_dir = sf_dir.rstrip("/")
    views = _loaded.setdefault(spark, {})
    if sf_dir not in views:
        views[sf_dir] = build(spark, sf_dir)
    return views[sf_dir]


def station_versions(spark: SparkSession, sf_dir: str):
    """``(WBAN, month, State, Location)`` over the driver tables."""
    return station_versions_view(_read(spark, sf_dir, "supplier"), _read(spark, sf_dir, "nation"))


def _read(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def build(spark: SparkSession, sf_dir: str) -> WeatherTables:
    def read(name):
        return _read(spark, sf_dir, name)

    return WeatherTables(
        station=station_view(read("supplier"), read("nation")),
        daily=daily_view(read("lineitem")),
        hourly=hourly_view(read("events")),
        monthly=monthly_view(read("orders")),
    )
