"""Physical plans: pruning, pushdown, broadcast only when proven, no Python in the hot path."""

import pytest

from stationspark.operators import stations as st
from stationspark.plans import queries as q
from stationspark.plans import registry
from stationspark.session import scratch_path
from stationspark.sources import readers, sinks
from stationspark.sources.tables import WeatherTables

from plan_utils import fact_rows_combined_before_exchange, plan

SF = "/root/testdata/sf0.01"


def formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def layered(spark, tables):
    root = scratch_path(spark, "plan-test")
    sinks.write_tables(WeatherTables(station=tables.station, daily=tables.daily,
                                     hourly=tables.hourly, monthly=tables.monthly), root)
    return readers.load_partitioned(spark, root)


def test_month_filter_prunes_partitions(layered):
    text = formatted(q.anomalous_days(layered, 3))
    assert "PartitionFilters: [isnotnull(month" in text and "(month#" in text
    text = formatted(q.unreliable_stations(layered, 2, 4))
    assert "PartitionFilters" in text and "TakeOrderedAndProject" in text


def test_scan_reads_only_needed_columns(layered):
    text = formatted(q.station_metric_avg(layered, "NATION_3", 2, 5))
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert any(line == "ReadSchema: struct<WBAN:int,AvgTemp:string>" for line in schemas), schemas


def test_station_filter_pushed_to_scan(layered):
    # a loaded dimension is first brought to one row per station; a table that
    # is known to be so takes the filter down to its scan
    root = scratch_path(layered.station.sparkSession, "plan-station")
    sinks.write_parquet(layered.station, f"{root}/station", partitioned=False)
    station = readers.read_partitioned(layered.station.sparkSession, root, "station")
    text = formatted(q.station_ids(WeatherTables(station=station), "NATION_3"))
    assert "EqualTo(State,NATION_3)" in text


def test_broadcast_only_with_proof(spark, tables):
    proven = formatted(q.hourly_profile(tables, "NATION_3", 1))
    assert "BroadcastHashJoin" in proven
    assert "partial_avg" in proven
    # Without proof, facts are first reduced to per-station sums and counts.
    fallback = formatted(q.station_metric_avg_by_state_month(tables, broadcast_rows=None))
    assert "partial_sum" in fallback and "partial_count" in fallback and "partial_avg" not in fallback


def test_row_count_bound(spark):
    df = spark.range(10)
    assert st.row_count_at_most(df, 10) and not st.row_count_at_most(df, 9)


def test_no_python_evaluation_in_registered_queries(spark):
    python_nodes = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                    "PythonUDF")
    for name, fn in registry.queries().items():
        text = plan(fn(spark, SF))
        assert not any(node in text for node in python_nodes), name


def test_top_k_is_take_ordered(tables):
    assert "TakeOrderedAndProject" in plan(q.unreliable_stations(tables, 1, 6))


def test_fallback_never_shuffles_fact_rows_for_a_join(spark, tables):
    """Without any broadcast, fact rows pass a partial aggregate before their first exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (q.station_metric_avg(tables, "NATION_3", 2, 5, broadcast_rows=None),
                   q.hourly_profile(tables, "NATION_3", 1, broadcast_rows=None),
                   q.station_metric_avg_by_state_month(tables, broadcast_rows=None),
                   q.hourly_profile_by_state(tables, 1, broadcast_rows=None),
                   q.metric_extrema(tables, "daily", "NATION_3", 3, "Tavg", broadcast_rows=None),
                   q.metric_extrema_by_state(tables, "daily", 3, "Tavg", broadcast_rows=None),
                   q.unreliable_stations(tables, 1, 6, state="NATION_3", broadcast_rows=None)):
            assert fact_rows_combined_before_exchange(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_station_proof_is_not_inherited(spark, tables):
    import dataclasses
    assert tables.station_fits(250_000)
    big = dataclasses.replace(tables, station=tables.station)
    assert big._fits == {} and big.station_fits(10) is False and tables.station_fits(250_000)


def test_clean_layer_pushes_numeric_filters(spark, tables):
    root = scratch_path(spark, "clean-plans")
    sinks.write_clean(tables, root)
    layer = readers.load_partitioned(spark, root)
    text = formatted(q.anomalous_days(layer, 3))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThan(Depart,5.0)" in pushed and "GreaterThan(Max5Speed,20.0)" in pushed
    assert "cast" not in text.lower() and "month#" in text
    farming = formatted(q.agri_days(layer, 6))
    assert "GreaterThanOrEqual(Tavg,60.0)" in farming and "EqualTo(PrecipTotal,0.0)" in farming
    flags = formatted(q.unreliable_stations(layer, 1, 6))
    assert "suspect_flags:int" in flags and "TavgFlag" not in flags


def test_profile_is_not_forced_into_one_task(tables):
    assert "Coalesce" not in plan(q.hourly_profile(tables, "NATION_3", 1))
