"""The aggregate queries over maintained partials instead of facts.

Each function answers what its namesake in :mod:`stationspark.plans.queries`
answers, with the same parameters, checks and columns, from the table of
:mod:`stationspark.operators.partials`.  Q1, Q2, Q6, Q7 and Q8 and their
grouped forms read stations x months x hours rows of one metric (a pushed
filter) in place of every reading.  Row-level questions (Q3, Q4) need the facts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.functions import clean, params
from stationspark.operators import aggregates as agg
from stationspark.operators import partials as pt
from stationspark.operators import stations as st
from stationspark.plans.queries import MONTH, _known_state, _months, _rounded
from stationspark.sources import catalog, readers
from stationspark.sources.schemas import SUSPECT_FLAGS, YEAR_COLUMN
from stationspark.sources.tables import WeatherTables

PARTIALS_DIR = "_partials"


@dataclass(frozen=True)
class MaintainedTables:
    """The station dimension and the partials of each kind."""

    dimension: WeatherTables
    partials: dict[str, DataFrame]

    def of(self, kind: str, metric: str) -> DataFrame:
        if kind not in self.partials:
            raise ValueError(f"no partials of kind {kind!r} were loaded")
        if metric != SUSPECT_FLAGS and metric not in catalog.METRICS[kind]:
            raise ValueError(f"unknown {kind} metric {metric!r}")
        return self.partials[kind].filter(F.col("metric") == metric)


def partials_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{PARTIALS_DIR}/{kind}"


def write(rows: DataFrame, root: str, kind: str) -> str:
    """Replaces the months that ``rows`` has, each as a whole."""
    path = partials_path(root, kind)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(YEAR_COLUMN, MONTH).parquet(path))
    return path


def build(tables: WeatherTables, root: str, year: int = 2013, kinds=pt.KINDS) -> str:
    """Partials of every loaded kind, from the facts."""
    for kind in kinds:
        if getattr(tables, kind) is not None:
            write(pt.build(tables.fact(kind), kind, year), root, kind)
    return root


def load(spark: SparkSession, root: str, station: DataFrame | None = None, year: int = 2013, kinds=pt.KINDS,
         station_months=readers.STATION_MONTHS) -> MaintainedTables:
    """Partials below ``root``, with the given dimension or that of the layer there."""
    own = WeatherTables(station=station) if station is not None else \
        readers.load_partitioned(spark, root, year=year, station_months=station_months, kinds=())
    frames = {k: spark.read.schema(pt.PARTIALS).parquet(partials_path(root, k)).filter(F.col(YEAR_COLUMN) == year)
              for k in kinds}
    return MaintainedTables(own, frames)


def _means(rows: DataFrame, tables: MaintainedTables, side: DataFrame, keys, attrs, broadcast, all_keys=None):
    """Mean by (attrs, keys): partials reduced to stations and keys, then joined and merged."""
    how = "inner" if attrs else "left_semi"
    merged = rows.groupBy("WBAN", *keys).agg(F.sum("v_sum").alias("v_sum"), F.sum("v_n").alias("v_n"))
    joined = merged.join(F.broadcast(side) if broadcast else side, "WBAN", how).drop("WBAN")
    if all_keys is not None:
        joined = joined.unionByName(all_keys.select(
            *attrs, *keys, F.lit(None).cast("double").alias("v_sum"), F.lit(0).cast("long").alias("v_n")))
    return agg.mean_of_partials(joined, keys=(*attrs, *keys))


def _unit(kind: str, metric: str):
    return F.lit(catalog.unit_of(kind, metric)).cast(T.StringType()).alias("unit")


def station_metric_avg(tables: MaintainedTables, state: str, month_start: int, month_end: int, metric: str = "AvgTemp",
                       kind: str = "monthly", broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS,
                       digits: int | None = None) -> DataFrame:
    dim = tables.dimension
    _known_state(dim, state)
    m0, m1 = params.check_month_range(month_start, month_end)
    side = st.in_state(dim.station, state).select("WBAN")
    means = _means(_months(tables.of(kind, metric), m0, m1), tables, side, (), (), dim.station_fits(broadcast_rows))
    return means.select(F.lit(metric).alias("metric"), _rounded("value", digits), _unit(kind, metric))


def station_metric_avg_by_state_month(tables: MaintainedTables, month_start: int = 1, month_end: int = 12,
                                      metric: str = "AvgTemp", kind: str = "monthly",
                                      broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    dim = tables.dimension
    m0, m1 = params.check_month_range(month_start, month_end)
    means = _means(_months(tables.of(kind, metric), m0, m1), tables, dim.station.select("WBAN", "State"), (MONTH,),
                   ("State",), dim.station_fits(broadcast_rows))
    return means.select("State", MONTH, F.lit(metric).alias("metric"), "value", _unit(kind, metric))


def monthly_avg_temperature(tables: MaintainedTables, month: int | None = None, offset: float = 32.0,
                            metric: str = "AvgTemp", digits: int | None = None) -> DataFrame:
    rows = tables.of("monthly", metric)
    if month is None:
        out = agg.mean_of_partials(rows, keys=(MONTH,))
    else:
        m = params.check_month(month)
        out = agg.mean_of_partials(_months(rows, m, m)).select(F.lit(m).alias(MONTH), "value")
    out = out.select(MONTH, clean.fahrenheit_to_celsius("value", offset).alias("avg_c"))
    return out.select(MONTH, clean.month_label(MONTH).alias("month_label"), _rounded("avg_c", digits))


def _hours(tables: MaintainedTables, month: int | None, metric: str, wban: int | None, include_on_hour: bool) -> DataFrame:
    rows = tables.of("hourly", metric).filter(F.col("hour").isNotNull())
    if not include_on_hour:
        rows = rows.filter(~F.col("on_hour"))
    if month is not None:
        m = params.check_month(month)
        rows = _months(rows, m, m)
    return rows if wban is None else rows.filter(F.col("WBAN") == F.lit(int(wban)))


def hourly_profile(tables: MaintainedTables, state: str, month: int, metric: str = "DryBulbFarenheit",
                   wban: int | None = None, include_on_hour: bool = False,
                   broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    dim = tables.dimension
    _known_state(dim, state)
    rows = _hours(tables, params.check_month(month), metric, wban, include_on_hour)
    side = st.in_state(dim.station, state).select("WBAN")
    return agg.finish_profile(_means(rows, tables, side, ("hour",), (), dim.station_fits(broadcast_rows),
                                     agg.hours_of_day(rows.sparkSession)))


def hourly_profile_by_state(tables: MaintainedTables, month: int | None, metric: str = "DryBulbFarenheit",
                            include_on_hour: bool = False,
                            broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    dim = tables.dimension
    rows = _hours(tables, month, metric, None, include_on_hour)
    keys = ("hour",) if month is not None else (MONTH, "hour")
    ranges = {MONTH: (1, 12), "hour": (0, 23)}
    means = _means(rows, tables, dim.station.select("WBAN", "State"), keys, ("State",), dim.station_fits(broadcast_rows),
                   agg.state_keys(dim.station, **{k: ranges[k] for k in keys}))
    return means.select("State", *keys, clean.hour_label("hour").alias("label"),
                        F.coalesce(F.col("value"), F.lit(0.0)).alias("value"))


def _extrema(tables: MaintainedTables, kind: str, month: int | None, metric: str, keys=()) -> DataFrame:
    rows = tables.of(kind, metric)
    if month is not None:
        rows = _months(rows, month, month)
    return pt.merge(rows, ("WBAN", *keys)).drop("v_sum", "v_n")


def metric_extrema(tables: MaintainedTables, kind, state: str, month: int, metric: str,
                   broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    dim, kind = tables.dimension, catalog.kind_of(kind)
    _known_state(dim, state)
    joined = st.attach_station(_extrema(tables, kind, params.check_month(month), metric), dim.station, state=state,
                               columns=("State",) + agg.STATION_ATTRS, broadcast=dim.station_fits(broadcast_rows))
    return agg.extrema_rows(joined).withColumn("unit", _unit(kind, metric))


def metric_extrema_by_state(tables: MaintainedTables, kind, month: int | None, metric: str,
                            broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    dim, kind = tables.dimension, catalog.kind_of(kind)
    m = None if month is None else params.check_month(month)
    keys = () if m is not None else (MONTH,)
    joined = st.attach_station(_extrema(tables, kind, m, metric, keys), dim.station,
                               columns=("State",) + agg.STATION_ATTRS, broadcast=dim.station_fits(broadcast_rows))
    months = {MONTH: (1, 12)} if m is None else {}
    return (agg.extrema_rows(joined, keys=("State", *keys), all_keys=agg.state_keys(dim.station, **months))
            .withColumn("unit", _unit(kind, metric)))


def suspect_counts(tables: MaintainedTables, month_start: int, month_end: int, state: str | None = None,
                   broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    dim = tables.dimension
    m0, m1 = params.check_month_range(month_start, month_end)
    rows = _months(tables.of("daily", SUSPECT_FLAGS), m0, m1)
    counts = rows.groupBy("WBAN").agg(F.sum("v_sum").cast("long").alias("suspicious_count"))
    if state is None:
        return counts
    return st.keep_stations(counts, st.in_state(dim.station, _known_state(dim, state)),
                            broadcast=dim.station_fits(broadcast_rows))


def unreliable_stations(tables: MaintainedTables, month_start: int, month_end: int, state: str | None = None, k: int = 10,
                        broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    params.check_positive("k", k)
    return agg.top_k(suspect_counts(tables, month_start, month_end, state, broadcast_rows), k, "suspicious_count")


def unreliable_stations_by_state(tables: MaintainedTables, month_start: int, month_end: int, k: int = 10,
                                 broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    params.check_positive("k", k)
    dim = tables.dimension
    placed = st.attach_station(suspect_counts(tables, month_start, month_end, None, broadcast_rows), dim.station,
                               columns=("State",), broadcast=dim.station_fits(broadcast_rows))
    return agg.top_k_per_group(placed, ("State",), k, "suspicious_count").select(
        "State", "rank", "WBAN", "suspicious_count")
