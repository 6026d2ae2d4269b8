"""A station holding a third of all rows: results stay exact, no plan ships its rows whole."""

import pytest
from pyspark.sql import functions as F

from stationspark.functions import clean
from stationspark.plans import queries as q
from stationspark.sources.tables import WeatherTables

from plan_utils import fact_rows_combined_before_exchange

HOT = 1


@pytest.fixture(scope="module")
def skewed(tables) -> WeatherTables:
    hot = F.when(F.col("YearMonthDay") % 3 == 0, F.lit(HOT)).otherwise(F.col("WBAN"))
    daily = tables.daily.withColumn("WBAN", hot)
    hourly = tables.hourly.withColumn("WBAN", F.when(F.col("Time") % 3 == 0, F.lit(HOT))
                                      .otherwise(F.col("WBAN")))
    return WeatherTables(station=tables.station, daily=daily, hourly=hourly, monthly=tables.monthly)


def test_hot_station_holds_a_third(skewed):
    total = skewed.daily.count()
    assert skewed.daily.filter(F.col("WBAN") == HOT).count() > total / 3.5


def _naive_mean_by_state_month(t):
    joined = t.daily.join(t.station.select("WBAN", "State"), "WBAN")
    return joined.groupBy("State", "month").agg(F.avg(clean.metric("Tavg")).alias("value"))


def test_means_agree_across_plans(skewed):
    naive = {(r.State, r.month): r.value for r in _naive_mean_by_state_month(skewed).collect()}
    for rows in (250_000, None):
        got = {(r.State, r.month): r.value for r in q.station_metric_avg_by_state_month(
            skewed, metric="Tavg", kind="daily", broadcast_rows=rows).collect()}
        assert got == naive
    hot_state = skewed.station.filter(F.col("WBAN") == HOT).first().State
    single = [q.station_metric_avg(skewed, hot_state, 1, 12, "Tavg", "daily", broadcast_rows=r).first().value
              for r in (250_000, None)]
    assert single[0] == single[1]


def test_profile_and_counts_agree_across_plans(skewed):
    state = skewed.station.filter(F.col("WBAN") == HOT).first().State
    a = q.hourly_profile_by_state(skewed, 1).collect()
    b = q.hourly_profile_by_state(skewed, 1, broadcast_rows=None).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    p1 = q.hourly_profile(skewed, state, 1).collect()
    p2 = q.hourly_profile(skewed, state, 1, broadcast_rows=None).collect()
    assert p1 == p2
    top = q.unreliable_stations(skewed, 1, 12).first()
    assert top.WBAN == HOT


def test_hot_rows_are_combined_before_any_exchange(skewed):
    """Fact rows reach a shuffle only through a partial aggregate."""
    for df in (q.station_metric_avg_by_state_month(skewed, metric="Tavg", kind="daily"),
               q.unreliable_stations(skewed, 1, 12),
               q.metric_extrema_by_state(skewed, "daily", 3, "Tavg")):
        assert fact_rows_combined_before_exchange(df)
