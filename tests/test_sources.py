"""Readers and writers: delimited text, partitioned layout, per-month files, JSON."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stationspark.operators.stations import latest_station_rows
from stationspark.plans import queries as q
from stationspark.session import local_path, scratch_path
from stationspark.sources import readers, schemas, sinks
from stationspark.sources.tables import WeatherTables
from stationspark.streaming import ingest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_round_trip_keeps_blanks_and_nulls(spark, tables):
    root = scratch_path(spark, "csv-test")
    sinks.write_delimited(tables.daily, f"{root}/daily", "daily")
    back = readers.read_partitioned(spark, root, "daily", fmt="csv")
    assert dict(back.dtypes)["WBAN"] == "int" and dict(back.dtypes)["month"] == "int"
    blank = back.filter(F.col("CodeSum") == " ").count()
    assert blank == tables.daily.filter(F.col("CodeSum") == " ").count() > 0
    assert back.filter(F.col("CodeSum").isNull()).count() == tables.daily.filter(F.col("CodeSum").isNull()).count()
    assert rows(back.select(*tables.daily.columns)) == rows(tables.daily)


def test_csv_explicit_schema_is_checked_against_header(spark, tables):
    root = scratch_path(spark, "csv-schema")
    sinks.write_delimited(tables.monthly, f"{root}/monthly", "monthly")
    ok = readers.read_delimited(spark, f"{root}/monthly", "monthly", schema=schemas.MONTHLY)
    assert ok.count() == 15000
    wrong = schemas.MONTHLY.fieldNames()[::-1]
    from pyspark.sql import types as T
    bad_schema = T.StructType([T.StructField(n, T.StringType()) for n in wrong])
    with pytest.raises(Exception):
        readers.read_delimited(spark, f"{root}/monthly", "monthly", schema=bad_schema).collect()


def test_pipe_station_file_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "station.txt"
    path.write_text("WBAN|State|Location|Latitude|Longitude\n03011|CO|TELLURIDE|37.95|-107.9\n"
                    "14739|MA|BOSTON|42.36|-71.01\n")
    df = readers.read_delimited(spark, str(path), "station")
    assert dict(df.dtypes) == {"WBAN": "int", "State": "string", "Location": "string",
                               "Latitude": "double", "Longitude": "double"}
    assert sorted(r.WBAN for r in df.collect()) == [3011, 14739]


def _write_month(root, yyyymm, kind, text):
    d = root / yyyymm
    d.mkdir(exist_ok=True, parents=True)
    (d / f"{kind}.txt").write_text(text)


def test_per_month_files_layout(spark, tmp_path):
    for m, temp, state in ((1, "40", "CO"), (2, "M", "CO"), (3, "50", "UT")):
        ym = f"2013{m:02d}"
        _write_month(tmp_path, ym, "station", f"WBAN|State|Location|Latitude|Longitude\n03011|{state}|X|1.0|2.0\n")
        _write_month(tmp_path, ym, "monthly", f"WBAN,YearMonth,AvgTemp\n03011,{ym},{temp}\n")
        _write_month(tmp_path, ym, "daily", "WBAN,YearMonthDay,Tavg,TavgFlag\n"
                                            f"03011,{ym}01,{temp},s\n")
        _write_month(tmp_path, ym, "hourly", f"WBAN,YearMonthDay,Time,DryBulbFarenheit\n03011,{ym}01,53,{temp}\n")
    t = readers.load_month_files(spark, str(tmp_path), months=range(1, 4), station_months=(1, 3))
    assert [r.State for r in t.station.collect()] == ["UT"]            # latest month wins
    monthly = t.monthly.orderBy("month").collect()
    assert [(r.WBAN, r.month, r.AvgTemp) for r in monthly] == [(3011, 1, "40"), (3011, 2, "M"), (3011, 3, "50")]
    assert q.station_metric_avg(t, "UT", 1, 3).first().value == 45.0
    assert [tuple(r) for r in q.unreliable_stations(t, 1, 3).collect()] == [(3011, 3)]
    only_feb = readers.read_month_files(spark, str(tmp_path), "monthly", months=[2])
    assert [r.month for r in only_feb.collect()] == [2]


def test_union_months_checks_column_sets(spark):
    a = spark.createDataFrame([(1, "x")], "WBAN int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, WBAN int")
    assert rows(readers.union_months([a, b])) == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3, "z", 1)], "WBAN int, v string, extra int")
    with pytest.raises(ValueError):
        readers.union_months([a, c])
    with pytest.raises(ValueError):
        readers.union_months([])


def test_partitioned_parquet_layout_round_trip(spark, tables):
    root = scratch_path(spark, "parquet-test")
    sinks.write_tables(WeatherTables(station=tables.station, monthly=tables.monthly), root)
    back = readers.read_partitioned(spark, root, "monthly")
    assert rows(back.select(*tables.monthly.columns)) == rows(tables.monthly)
    one = readers.read_month(spark, root, "monthly", 3)
    assert one.count() == tables.monthly.filter("month = 3").count()
    # Re-writing a single month replaces only that month.
    sinks.write_parquet(tables.monthly.filter("month = 3").limit(5), f"{root}/monthly")
    again = readers.read_partitioned(spark, root, "monthly")
    assert again.filter("month = 3").count() == 5
    assert again.filter("month = 4").count() == tables.monthly.filter("month = 4").count()


def test_json_records(spark, tables):
    df = q.anomalous_days(tables, 3)
    rec = sinks.records_json(df).first().record
    assert list(json.loads(rec)) == ["YearMonthDay", "WBAN", "Depart", "Max5Speed", "PrecipTotal"]
    out = scratch_path(spark, "json-test")
    sinks.write_records(df, out)
    files = [f for f in os.listdir(local_path(out)) if f.endswith(".json")]
    lines = [json.loads(x) for f in files for x in open(os.path.join(local_path(out), f))]
    assert len(lines) == df.count()
    assert any(r["Max5Speed"] is None for r in lines)


def test_latest_station_rows(spark):
    df = spark.createDataFrame([(1, "A", 1), (1, "B", 3), (2, "C", 2)], "WBAN int, State string, month int")
    assert rows(latest_station_rows(df)) == [(1, "B"), (2, "C")]


def test_month_files_written_by_spark(spark, tables):
    """A ``{yyyymm}/{kind}.txt`` written by Spark is a directory of part files."""
    root = scratch_path(spark, "month-files")
    for m in (2, 3):
        one = tables.daily.filter(F.col("month") == m).drop("month")
        sinks.write_delimited(one, f"{root}/2013{m:02d}/daily.txt", "daily", partitioned=False)
    back = readers.read_month_files(spark, root, "daily")
    assert rows(back.select(*tables.daily.columns)) == rows(tables.daily.filter(F.col("month").isin(2, 3)))
    only_march = readers.read_month_files(spark, root, "daily", months=[3])
    assert {r.month for r in only_march.select("month").distinct().collect()} == {3}


def test_month_files_with_different_column_orders(spark, tmp_path):
    for m, header, row in ((1, "WBAN,YearMonth,AvgTemp", "3011,201301,40"),
                           (2, "AvgTemp,WBAN,YearMonth", "50,3011,201302")):
        _write_month(tmp_path, f"2013{m:02d}", "monthly", f"{header}\n{row}\n")
    with pytest.raises(Exception):
        readers.read_month_files(spark, str(tmp_path), "monthly").collect()
    by_name = readers.read_month_files(spark, str(tmp_path), "monthly", months=[1, 2], by_name=True)
    assert sorted((r.WBAN, r.month, r.AvgTemp) for r in by_name.collect()) == [(3011, 1, "40"), (3011, 2, "50")]


def test_clean_layer_answers_as_the_raw_tables(spark, tables):
    root = scratch_path(spark, "clean-layer")
    sinks.write_clean(tables, root)
    layer = readers.load_partitioned(spark, root)
    assert dict(layer.daily.dtypes)["Depart"] == "double" and dict(layer.daily.dtypes)["CodeSum"] == "string"
    for ask in (lambda t: q.anomalous_days(t, 3), lambda t: q.agri_days(t, 6), lambda t: q.unreliable_stations(t, 1, 6),
                lambda t: q.hourly_profile_by_state(t, None), lambda t: q.metric_extrema_by_state(t, "daily", 3, "Tavg"),
                lambda t: q.station_metric_avg(t, "NATION_3", 2, 5)):
        assert rows(ask(layer)) == rows(ask(tables))


def test_both_loaders_give_one_station_dimension(spark, tmp_path):
    for m, temp, state in ((1, "10", "CO"), (2, "20", "CO"), (3, "60", "UT")):
        ym = f"2013{m:02d}"
        _write_month(tmp_path / "raw", ym, "station", f"WBAN|State|Location|Latitude|Longitude\n3011|{state}|X|1.0|2.0\n"
                                                      f"3011|{state}|W|1.0|2.0\n")
        _write_month(tmp_path / "raw", ym, "monthly", f"WBAN,YearMonth,AvgTemp\n3011,{ym},{temp}\n")
    out = str(tmp_path / "layer")
    ingest.ingest_available(spark, str(tmp_path / "raw"), out)
    files = readers.load_month_files(spark, str(tmp_path / "raw"), kinds=("monthly",))
    layer = readers.load_partitioned(spark, out)               # daily and hourly were never ingested
    for t in (files, layer):
        assert [(r.WBAN, r.State, r.Location) for r in t.station.collect()] == [(3011, "CO", "X")]
        assert q.station_metric_avg(t, "CO", 1, 3).first().value == 30.0
    with pytest.raises(ValueError):
        layer.fact("daily")
    with pytest.raises(AnalysisException):
        readers.load_partitioned(spark, out, kinds=("daily",))


def test_repeated_station_id_counts_once_in_every_load(spark):
    root = scratch_path(spark, "repeated")
    station = spark.createDataFrame([(1, "AA", "A", 1.0, 2.0), (1, "AA", "A", 1.0, 2.0), (2, "AA", "B", 1.0, 2.0)], schemas.STATION)
    monthly = spark.createDataFrame([(1, 201301, "10", 1), (2, 201301, "30", 1)], "WBAN int, YearMonth int, AvgTemp string, month int")
    hourly = spark.createDataFrame([(1, 20130101, 30, "10", 1), (2, 20130101, 30, "30", 1)],
                                   "WBAN int, YearMonthDay int, Time int, DryBulbFarenheit string, month int")
    sinks.write_tables(WeatherTables(station=station, monthly=monthly, hourly=hourly), root)
    t = readers.load_partitioned(spark, root)
    assert t.station.count() == 2
    assert q.station_metric_avg_by_state_month(t).first().value == q.station_metric_avg(t, "AA", 1, 1).first().value == 20.0
    assert q.hourly_profile_by_state(t, 1).filter("hour = 0").first().value == q.hourly_profile(t, "AA", 1).first().value == 20.0
    assert q.metric_extrema_by_state(t, "monthly", 1, "AvgTemp").count() == 2


def test_month_files_need_a_month(spark):
    df = spark.createDataFrame([(1, 201301, "10", None)], "WBAN int, YearMonth int, AvgTemp string, month int")
    with pytest.raises(ValueError):
        sinks.write_month_files(df, scratch_path(spark, "no-month"), "monthly")
