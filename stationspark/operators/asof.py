"""As-of join with the station dimension: the station row valid in a fact's month.

A station may move or change its name; every month's station file is a version
of its row, valid from that month until the next one.  A fact belongs to the
last version not after its month.  Nothing is compared by inequality: facts and
versions are put one after the other, ordered by station and month, and the
last version seen is carried forward.

What is ordered are never the facts themselves but one row for each station
and month (their partial aggregates, or the distinct pairs), so a station that
holds a third of all readings is still a dozen rows a year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationspark.functions import clean, params
from stationspark.operators import aggregates as agg
from stationspark.sources import catalog
from stationspark.sources.schemas import PARTITION_COLUMN
from stationspark.sources.tables import WeatherTables

AT = (PARTITION_COLUMN,)


def station_versions(station: DataFrame, at=AT) -> DataFrame:
    """One row for each station and month of a station file: of several rows in
    one file the greatest by its attributes, so every load gives the same."""
    attrs = [c for c in station.columns if c != "WBAN" and c not in at]
    rows = station.groupBy("WBAN", *at).agg(F.max(F.struct(*attrs)).alias("_row"))
    return rows.select("WBAN", *at, *[F.col(f"_row.{c}").alias(c) for c in attrs])


def carry_forward(rows: DataFrame, versions: DataFrame, attrs, at=AT, keep_unknown: bool = False) -> DataFrame:
    """``rows`` (one or a few for each station and month) with the attributes
    of the version valid then; rows before the first version drop out, or keep
    nulls with ``keep_unknown``."""
    others = [c for c in rows.columns if c != "WBAN" and c not in at]
    facts = rows.select("WBAN", *at, F.lit(1).alias("_fact"), F.struct(*others, F.lit(1).alias("_one")).alias("_own"))
    known = versions.select("WBAN", *at, F.lit(0).alias("_fact"), F.struct(*attrs).alias("_row"))
    together = facts.unionByName(known, allowMissingColumns=True)
    until_here = (Window.partitionBy("WBAN").orderBy(*at, "_fact")
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    valid = together.withColumn("_valid", F.last("_row", ignorenulls=True).over(until_here)).filter(F.col("_fact") == 1)
    if not keep_unknown:
        valid = valid.filter(F.col("_valid").isNotNull())
    return valid.select("WBAN", *at, *[F.col(f"_own.{c}").alias(c) for c in others],
                        *[F.col(f"_valid.{c}").alias(c) for c in attrs])


def attach_valid_station(fact: DataFrame, versions: DataFrame, columns=("State",), how: str = "inner", at=AT,
                         broadcast: bool = False) -> DataFrame:
    """Every fact row with the attributes of its station in its month.

    The pairs of station and month are resolved first, then joined by
    equality: by broadcast where their number is proven, else by shuffle, where
    adaptive execution splits a hot station's partition.
    """
    pairs = carry_forward(fact.select("WBAN", *at).distinct(), versions, columns, at)
    return fact.join(F.broadcast(pairs) if broadcast else pairs, ["WBAN", *at], how)


def station_metric_avg_by_state_month(tables: WeatherTables, versions: DataFrame, month_start: int = 1, month_end: int = 12,
                                      metric: str = "AvgTemp", kind: str = "monthly") -> DataFrame:
    """Grouped Q1 by the state that a station was in at the time: ``(State,
    month, metric, value, unit)``.  Facts are reduced to stations and months,
    these meet the versions, and what is left is merged by state."""
    m0, m1 = params.check_month_range(month_start, month_end)
    fact = tables.fact(kind)
    params.check_metric(fact, kind, metric)
    rows = fact.filter(F.col(PARTITION_COLUMN).between(m0, m1))
    partials = agg.mean_partials(rows, clean.values_of(fact)(metric), keys=AT)
    placed = carry_forward(partials, versions, ("State",))
    return agg.mean_of_partials(placed, keys=("State", *AT)).select(
        "State", *AT, F.lit(metric).alias("metric"), "value",
        F.lit(catalog.unit_of(kind, metric)).cast("string").alias("unit"))


def moved_stations(versions: DataFrame, at=AT) -> DataFrame:
    """Every change of state: ``(WBAN, month, before, State)``."""
    order = Window.partitionBy("WBAN").orderBy(*at)
    rows = versions.select("WBAN", *at, F.lag("State").over(order).alias("before"), "State")
    return rows.filter(F.col("before").isNotNull() & ~F.col("before").eqNullSafe(F.col("State")))


__all__ = ["station_versions", "carry_forward", "attach_valid_station", "station_metric_avg_by_state_month",
           "moved_stations"]
