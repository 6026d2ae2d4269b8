"""Named query instances over the driver tables (used by the entry point and bench).

Each entry maps a name to ``fn(spark, sf_dir) -> DataFrame`` with fixed
parameters.  Every entry reads whole tables; none filters rows to keep a
check cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationspark.plans import blocks, layers
from stationspark.plans import queries as q
from stationspark.sources import fixtures

# Parameters of the registered instances (a state and months that have data
# in the driver tables at every scale factor).
STATE = "NATION_3"
STATION = 68


def _on_tables(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(fixtures.load(spark, sf_dir))
    run.__doc__ = build.__doc__
    return run


COMPOSITE: dict[str, Callable] = {
    "station_metric_avg": lambda t: q.station_metric_avg(t, STATE, 2, 5, "AvgTemp"),
    "station_metric_avg_rounded": lambda t: q.station_metric_avg(t, STATE, 1, 12, "Tavg", "daily",
                                                                 digits=2),
    "station_metric_avg_by_state_month": lambda t: q.station_metric_avg_by_state_month(t),
    "monthly_avg_temp_c": lambda t: q.monthly_avg_temperature(t),
    "monthly_avg_temp_c_offset31": lambda t: q.monthly_avg_temperature(t, offset=31.0),
    "anomalous_days": lambda t: q.anomalous_days(t, 3),
    "anomalous_days_formatted": lambda t: q.anomalous_days_formatted(t, 3),
    "anomalous_days_count": lambda t: q.anomalous_days_count(t, 3),
    "anomalous_days_count_by_month": lambda t: q.anomalous_days_count(t, None),
    "agri_days": lambda t: q.agri_days(t, 6),
    "agri_days_formatted": lambda t: q.agri_days_formatted(t, 6),
    "agri_days_station": lambda t: q.agri_days(t, 6, wban=1),
    "agri_days_stations": lambda t: q.agri_days_stations(t, 6),
    "agri_days_count": lambda t: q.agri_days_count(t, 6),
    "agri_days_count_by_month": lambda t: q.agri_days_count(t, None),
    "station_ids": lambda t: q.station_ids(t, STATE),
    "hourly_profile": lambda t: q.hourly_profile(t, STATE, 1),
    "hourly_profile_station": lambda t: q.hourly_profile(t, STATE, 1, wban=STATION),
    "hourly_profile_by_state": lambda t: q.hourly_profile_by_state(t, 1),
    "hourly_profile_by_state_month": lambda t: q.hourly_profile_by_state(t, None),
    "metric_extrema_daily": lambda t: q.metric_extrema(t, "daily", STATE, 3, "Tavg"),
    "metric_extrema_hourly": lambda t: q.metric_extrema(t, 2, STATE, 1, "DryBulbFarenheit"),
    "metric_extrema_monthly": lambda t: q.metric_extrema(t, "monthly", STATE, 3, "AvgTemp"),
    "metric_extrema_by_state": lambda t: q.metric_extrema_by_state(t, "daily", 3, "Tavg"),
    "metric_extrema_by_state_month": lambda t: q.metric_extrema_by_state(t, "monthly", None, "AvgTemp"),
    "unreliable_top10_all": lambda t: q.unreliable_stations(t, 1, 6),
    "unreliable_top10_state": lambda t: q.unreliable_stations(t, 1, 6, state=STATE),
    "unreliable_top2_state": lambda t: q.unreliable_stations(t, 1, 6, state=STATE, k=2),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _on_tables(build) for name, build in COMPOSITE.items()}
    out.update(blocks.registered())
    out.update(layers.registered())
    return out
