"""Versioned ingest and maintained partials: corrections, replays, late files."""

import os
import re

import pytest

from stationspark.operators import partials as pt
from stationspark.plans import layers, maintained, registry
from stationspark.plans import queries as q
from stationspark.sources import fixtures, readers
from stationspark.streaming import versioned

STATIONS = "WBAN|State|Location|Latitude|Longitude\n03011|CO|X|1.0|2.0\n00007|UT|Y|3.0|4.0\n"
HEADERS = {"monthly": "WBAN,YearMonth,AvgTemp", "daily": "WBAN,YearMonthDay,Tavg,TavgFlag",
           "hourly": "WBAN,YearMonthDay,Time,DryBulbFarenheit", "station": None}


def deliver(path, kind, rows, at):
    """A file of a kind, delivered at a given second."""
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(STATIONS if kind == "station" else "\n".join([HEADERS[kind], *rows]) + "\n")
    os.utime(path, (at, at))


def rows_of(spark, root, kind, *columns):
    return sorted(map(tuple, spark.read.parquet(f"{root}/{kind}").select(*columns).collect()), key=str)


def snapshot(spark, root, kind):
    out = {}
    for name in (kind, f"_partials/{kind}", f"_history/{kind}"):
        df = spark.read.parquet(f"{root}/{name}")
        out[name] = sorted((str(sorted(r.asDict().items())) for r in df.collect()))
    return out


def agree(spark, root):
    """Every question over the partials answers as over the current rows."""
    facts, own = readers.load_partitioned(spark, root), maintained.load(spark, root)
    pairs = [
        (q.station_metric_avg(facts, "CO", 1, 12), maintained.station_metric_avg(own, "CO", 1, 12)),
        (q.station_metric_avg(facts, "CO", 1, 12, "Tavg", "daily"),
         maintained.station_metric_avg(own, "CO", 1, 12, "Tavg", "daily")),
        (q.station_metric_avg_by_state_month(facts), maintained.station_metric_avg_by_state_month(own)),
        (q.monthly_avg_temperature(facts), maintained.monthly_avg_temperature(own)),
        (q.monthly_avg_temperature(facts, 7), maintained.monthly_avg_temperature(own, 7)),
        (q.metric_extrema(facts, 1, "CO", 1, "Tavg"), maintained.metric_extrema(own, 1, "CO", 1, "Tavg")),
        (q.metric_extrema_by_state(facts, 3, None, "AvgTemp"), maintained.metric_extrema_by_state(own, 3, None, "AvgTemp")),
        (q.unreliable_stations(facts, 1, 12), maintained.unreliable_stations(own, 1, 12)),
        (q.unreliable_stations(facts, 1, 1, "UT"), maintained.unreliable_stations(own, 1, 1, "UT")),
    ]
    for on_hour in (False, True):
        pairs += [(q.hourly_profile(facts, "CO", 1, include_on_hour=on_hour),
                   maintained.hourly_profile(own, "CO", 1, include_on_hour=on_hour)),
                  (q.hourly_profile_by_state(facts, None, include_on_hour=on_hour),
                   maintained.hourly_profile_by_state(own, None, include_on_hour=on_hour))]
    for want, got in pairs:
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def first_delivery(raw):
    deliver(raw / "201301/station.txt", "station", None, 1000)
    deliver(raw / "201301/monthly.txt", "monthly", ["03011,201301,40", "00007,201301,M"], 1000)
    deliver(raw / "201302/monthly.txt", "monthly", ["03011,201302,50"], 1000)
    deliver(raw / "201301/daily.txt", "daily", ["03011,20130101,30,s", "03011,20130102,32, ", "00007,20130101,M,s",
                                                "bad,20130103,44, ", ",20130103,45, "], 1000)
    deliver(raw / "201301/hourly.txt", "hourly", ["03011,20130101,0030,10", "03011,20130101,0100,20",
                                                  "03011,20130101,0130,30", "00007,20130101,2400,99",
                                                  "00007,20130101,2359,M", "3011,20130101,0030,12"], 1000)


def test_corrections_replays_and_late_files(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "layer")
    first_delivery(raw)
    versioned.ingest_available(spark, str(raw), root)
    assert rows_of(spark, root, "monthly", "WBAN", "month", "AvgTemp") == [(3011, 1, "40"), (3011, 2, "50"), (7, 1, "M")]
    # a file that repeats a key keeps its rows
    assert rows_of(spark, root, "hourly", "Time", "DryBulbFarenheit").count((30, "10")) == 1
    assert len(rows_of(spark, root, "hourly", "WBAN")) == 6
    agree(spark, root)

    # a correction of part of a month, one new key; another month stays
    deliver(raw / "201301/daily.2.txt", "daily", ["03011,20130102,35, ", "00007,20130105,28, "], 3000)
    deliver(raw / "201301-corrected/monthly.txt", "monthly", ["00007,201301,70"], 3000)
    versioned.ingest_available(spark, str(raw), root)
    assert rows_of(spark, root, "daily", "WBAN", "YearMonthDay", "Tavg") == sorted([
        (3011, 20130101, "30"), (3011, 20130102, "35"), (7, 20130101, "M"), (7, 20130105, "28")], key=str)
    assert rows_of(spark, root, "monthly", "WBAN", "month", "AvgTemp") == [(3011, 1, "40"), (3011, 2, "50"), (7, 1, "70")]
    agree(spark, root)

    # an older file that comes late adds what no newer file has and changes nothing else
    deliver(raw / "201301/daily.late.txt", "daily", ["03011,20130102,99, ", "03011,20130109,31,s"], 2000)
    versioned.ingest_available(spark, str(raw), root)
    assert rows_of(spark, root, "daily", "WBAN", "YearMonthDay", "Tavg") == sorted([
        (3011, 20130101, "30"), (3011, 20130102, "35"), (3011, 20130109, "31"), (7, 20130101, "M"), (7, 20130105, "28")],
        key=str)
    agree(spark, root)
    # history keeps every row of every file
    history = spark.read.parquet(f"{root}/_history/daily")
    assert history.count() == 9 and history.select("_file").distinct().count() == 3

    # nothing new: nothing happens; a replayed batch: nothing changes
    before = snapshot(spark, root, "daily")
    versioned.ingest_available(spark, str(raw), root)
    assert snapshot(spark, root, "daily") == before
    rows = spark.read.schema(versioned.header_schema(spark, str(raw / "201301/daily.txt"), "daily")).option(
        "header", True).csv(str(raw / "201301/daily.txt"))
    versioned.apply_batch(versioned.stamped(rows, "daily"), "000000000", root, "daily")
    assert snapshot(spark, root, "daily") == before


def test_file_delivered_again_under_its_path(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "layer")
    first_delivery(raw)
    versioned.ingest_available(spark, str(raw), root)
    path = raw / "201302/monthly.txt"
    deliver(path, "monthly", ["03011,201302,55", "00007,201302,66"], 5000)
    schema = versioned.header_schema(spark, str(path), "monthly")
    for _ in range(2):
        assert versioned.restate(spark, [str(path)], root, "monthly", schema) == [(2013, 2)]
        assert rows_of(spark, root, "monthly", "WBAN", "month", "AvgTemp") == [
            (3011, 1, "40"), (3011, 2, "55"), (7, 1, "M"), (7, 2, "66")]
        assert spark.read.parquet(f"{root}/_history/monthly").count() == 5
    agree(spark, root)


def test_month_of_one_file_is_not_shuffled(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "layer")
    first_delivery(raw)
    versioned.ingest_available(spark, str(raw), root, with_partials=False)
    schema = versioned.header_schema(spark, str(raw / "201301/daily.txt"), "daily")
    history = versioned.read_history(spark, root, "daily", schema)
    plan = versioned.latest_rows(history, ("WBAN", "YearMonthDay"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert not os.path.exists(f"{root}/_partials")


@pytest.mark.parametrize("name", layers.MAINTAINED)
def test_registered_partials_equal_the_fact_scan(spark, name):
    every = registry.queries()
    want = every[layers.MAINTAINED[name][1]](spark, "/root/testdata/sf0.001")
    got = every[name](spark, "/root/testdata/sf0.001")
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_partials_are_pruned_and_pushed(spark, tmp_path):
    tables = fixtures.load(spark, "/root/testdata/sf0.001")
    maintained.build(tables, str(tmp_path))
    own = maintained.load(spark, str(tmp_path), station=tables.station)
    plan = maintained.station_metric_avg(own, "NATION_3", 2, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(metric), EqualTo(metric,AvgTemp)" in plan
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan
    with pytest.raises(ValueError):
        own.of("monthly", "Tavg")
    with pytest.raises(ValueError):
        pt.build(tables.daily, "precip")


def test_partials_are_built_by_compiled_code(spark, capsys):
    """HotSpot compiles no method of more than 8000 bytes; the parsing of all
    daily metrics side by side has to stay below."""
    facts = fixtures.load(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # else code is generated only when the query runs
    try:
        pt.build(facts.daily, "daily", 2013).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000
