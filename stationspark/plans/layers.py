"""Registered queries over derived layers: maintained partials, station
versions, the clustered layer, chosen units.  Each layer is written once for
each session and directory from the driver tables, as an ingest keeps it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationspark.operators import asof, readings
from stationspark.plans import converted, maintained
from stationspark.plans import queries as q
from stationspark.session import scratch_path
from stationspark.sources import checked, clustered, fixtures, header_groups, schemas, sinks

STATE = "NATION_3"
STATION = 68

_written: dict[tuple, str] = {}


def _layer(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _maintained(build: Callable[[maintained.MaintainedTables], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = fixtures.load(spark, sf_dir)
        root = _layer(spark, sf_dir, "partials", lambda path: maintained.build(tables, path))
        own = maintained.load(spark, root, station=tables.station)
        own.dimension._fits.update(tables._fits)
        return build(own)

    return run


def _asof(build: Callable):
    return lambda spark, sf_dir: build(fixtures.load(spark, sf_dir), fixtures.station_versions(spark, sf_dir))


def _tables(build: Callable):
    return lambda spark, sf_dir: build(fixtures.load(spark, sf_dir))


def _clustered_station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fixtures.load(spark, sf_dir).daily
    path = _layer(spark, sf_dir, "clustered",
                  lambda to: clustered.write(daily, to, ranges=clustered.ranges_for(daily.count(), 100_000)))
    return clustered.of_station(clustered.read(spark, path, schemas.by_month(schemas.DAILY)), STATION)


def _flawed_lines(monthly: DataFrame) -> DataFrame:
    """Lines of monthly rows with flaws (fixture rule): a station that is no
    number, none at all, a value too few."""
    month, temp = F.col("YearMonth").cast("string"), F.col("AvgTemp")
    station = F.when(F.col("WBAN") % 17 == 3, F.concat(F.lit("x"), "WBAN")).when(F.col("WBAN") % 19 == 4, F.lit("")) \
        .otherwise(F.col("WBAN").cast("string"))
    line = F.when(F.col("WBAN") % 23 == 5, F.concat_ws(",", station, month)).otherwise(F.concat_ws(",", station, month, temp))
    return monthly.select(line.alias("value"))


def _checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines were accepted, and rejected for each reason."""
    def write(path: str) -> None:
        _flawed_lines(fixtures.load(spark, sf_dir).monthly).write.text(path)

    accepted, rejected, _ = checked.load(spark, _layer(spark, sf_dir, "flawed-lines", write), "monthly",
                                         scratch_path(spark, "checked"), month=1, names=("WBAN", "YearMonth", "AvgTemp"))
    reasons = checked.reason_counts(rejected).groupBy("reason").agg(F.sum("n").alias("n_lines"))
    return reasons.unionByName(accepted.agg(F.count(F.lit(1)).alias("n_lines")).withColumn("reason", F.lit("accepted")))


def _scan_header_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month files whose columns are in one order until June and another after."""
    monthly = fixtures.load(spark, sf_dir).monthly

    def write(path: str) -> None:
        sinks.write_month_files(monthly.filter("month <= 6"), path, "monthly")
        sinks.write_month_files(monthly.filter("month > 6").select("AvgTemp", "WBAN", "YearMonth", "month"), path, "monthly")

    return header_groups.read_month_files(spark, _layer(spark, sf_dir, "two-orders", write), "monthly")


#: Name -> (query, the registered query that gives the same rows from the facts).
MAINTAINED = {
    "maintained_metric_avg": (lambda t: maintained.station_metric_avg(t, STATE, 2, 5), "station_metric_avg"),
    "maintained_metric_avg_by_state_month": (
        lambda t: maintained.station_metric_avg_by_state_month(t), "station_metric_avg_by_state_month"),
    "maintained_monthly_avg_temp_c": (lambda t: maintained.monthly_avg_temperature(t), "monthly_avg_temp_c"),
    "maintained_hourly_profile": (lambda t: maintained.hourly_profile(t, STATE, 1), "hourly_profile"),
    "maintained_hourly_profile_by_state_month": (
        lambda t: maintained.hourly_profile_by_state(t, None), "hourly_profile_by_state_month"),
    "maintained_metric_extrema_daily": (
        lambda t: maintained.metric_extrema(t, "daily", STATE, 3, "Tavg"), "metric_extrema_daily"),
    "maintained_metric_extrema_by_state_month": (
        lambda t: maintained.metric_extrema_by_state(t, "monthly", None, "AvgTemp"), "metric_extrema_by_state_month"),
    "maintained_unreliable_top10_state": (
        lambda t: maintained.unreliable_stations(t, 1, 6, state=STATE), "unreliable_top10_state"),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _maintained(build) for name, (build, _) in MAINTAINED.items()} | {
        "join_station_asof": _asof(lambda t, v: asof.attach_valid_station(t.monthly, v, ("State", "Location"))),
        "asof_metric_avg_by_state_month": _asof(asof.station_metric_avg_by_state_month),
        "moved_stations": _asof(lambda t, v: asof.moved_stations(v)),
        "clustered_station_rows": _clustered_station_rows,
        "scan_header_groups": _scan_header_groups,
        "checked_lines": _checked_lines,
        "distinct_readings": _tables(lambda t: readings.distinct_readings(t.hourly, "hourly")),
        "duplicate_readings": _tables(lambda t: readings.duplicate_counts(t.hourly, "hourly")),
        "unreliable_top3_by_state": _tables(lambda t: q.unreliable_stations_by_state(t, 1, 6, k=3)),
        "station_metric_avg_celsius": _tables(lambda t: converted.station_metric_avg(t, STATE, 2, 5, "AvgTemp", "°C")),
        "metric_extrema_daily_celsius": _tables(
            lambda t: converted.metric_extrema(t, "daily", STATE, 3, "Tavg", "°C")),
        "metric_extrema_by_state_kmh": _tables(
            lambda t: converted.metric_extrema_by_state(t, "daily", 3, "Max5Speed", "km/h")),
    }
