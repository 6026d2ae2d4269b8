"""Checked loading, scans by header group, readings once each, manifests."""

import pytest
from pyspark.sql import functions as F

from stationspark.functions import clean
from stationspark.operators import readings
from stationspark.plans import queries as q
from stationspark.sources import checked, fixtures, header_groups, manifest, readers, schemas, sinks

HOURLY = "WBAN int, YearMonthDay int, Time int, DryBulbFarenheit string"


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


# -------------------------------------------------------------- checked ----

def test_every_line_is_accepted_or_rejected(spark, tmp_path):
    head = "WBAN,YearMonth,AvgTemp"
    write(tmp_path / "201301/monthly.txt", head, "03011,201301,40", "x7,201301,50", ",201301,60", "  ,201301,61",
          "9,201301", "9,201301,1,2", "9,never,T", "", "8,201301,M", '7,201301,"a,b"')
    write(tmp_path / "201302/monthly.txt", head, "03011,201302,", "9,,4")
    accepted, rejected, counts = checked.load(spark, f"{tmp_path}/*/monthly.txt", "monthly", str(tmp_path / "out"))
    assert counts == {"lines": 11, "accepted": 4, "rejected": 7}
    assert sorted(map(tuple, accepted.select("WBAN", "YearMonth", "AvgTemp", "month").collect())) == [
        (7, 201301, "a,b", 1), (8, 201301, "M", 1), (3011, 201301, "40", 1), (3011, 201302, None, 2)]
    got = sorted((r["_file"][-18:], r["_reason"], r["_record"]) for r in rejected.collect())
    assert got == [
        ("201301/monthly.txt", "WBAN is missing", "  ,201301,61"), ("201301/monthly.txt", "WBAN is missing", ",201301,60"),
        ("201301/monthly.txt", "WBAN is no number: x7", "x7,201301,50"),
        ("201301/monthly.txt", "YearMonth is no number: never", "9,never,T"),
        ("201301/monthly.txt", "wrong number of values", "9,201301"),
        ("201301/monthly.txt", "wrong number of values", "9,201301,1,2"),
        ("201302/monthly.txt", "YearMonth is missing", "9,,4")]
    reasons = {(r["reason"], r["n"]) for r in checked.reason_counts(rejected).collect()}
    assert ("YearMonth is no number", 1) in reasons and ("WBAN is missing", 2) in reasons


def test_files_are_read_once(spark, tmp_path):
    write(tmp_path / "201301/monthly.txt", "WBAN,YearMonth,AvgTemp", "1,201301,40", "x,201301,50")
    plan = checked.read(spark, f"{tmp_path}/*/monthly.txt", "monthly")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan


# -------------------------------------------------------- header groups ----

def test_one_scan_for_each_header(spark, tmp_path):
    orders = {1: "WBAN,YearMonth,AvgTemp", 2: "AvgTemp,WBAN,YearMonth", 3: "WBAN,YearMonth,AvgTemp", 4: "AvgTemp,WBAN,YearMonth"}
    for m, head in orders.items():
        values = {"WBAN": "03011", "YearMonth": f"2013{m:02d}", "AvgTemp": str(40 + m)}
        write(tmp_path / f"2013{m:02d}/monthly.txt", head, ",".join(values[c] for c in head.split(",")))
    (tmp_path / "201305").mkdir()
    (tmp_path / "201305/monthly.txt").write_text("")
    got = header_groups.read_month_files(spark, str(tmp_path), "monthly")
    assert sorted(map(tuple, got.select("WBAN", "YearMonth", "AvgTemp", "month").collect())) == [
        (3011, 201300 + m, str(40 + m), m) for m in range(1, 5)]
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    by_name = readers.read_month_files(spark, str(tmp_path), "monthly", months=[1, 2, 3, 4], by_name=True)
    assert sorted(map(tuple, by_name.select(*got.columns).collect())) == sorted(map(tuple, got.collect()))
    assert by_name._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 4
    write(tmp_path / "201306/monthly.txt", "WBAN,YearMonth,Other", "1,201306,2")
    with pytest.raises(ValueError):
        header_groups.read_month_files(spark, str(tmp_path), "monthly")
    with pytest.raises(ValueError):
        header_groups.read_month_files(spark, str(tmp_path), "daily")


# ------------------------------------------------------------- readings ----

ONCE = ["3011,20130101,30,40", "3011,20130101,130,41", "7,20130101,30,M", "7,20130102,30,M"]
KEYLESS = [",20130101,30,1", ",20130101,30,1"]


def test_delivered_twice_counts_once_in_both_paths(spark, tmp_path):
    head, raw, out = "WBAN,YearMonthDay,Time,DryBulbFarenheit", tmp_path / "raw", str(tmp_path / "out")
    write(raw / "201301/hourly.txt", head, *ONCE, ONCE[0], *KEYLESS)
    layout = readers.header_schema(spark, str(raw / "201301/hourly.txt"), "hourly")

    def ingest():
        query = readings.start_distinct_ingest(spark, str(raw), "hourly", out, layout)
        query.awaitTermination()
        assert query.exception() is None

    ingest()
    # the next month's file brings the same readings once more, and one that is new
    write(raw / "201302/hourly.txt", head, *ONCE, "3011,20130203,1,44")
    ingest()
    ingest()
    streamed = readers.read_partitioned(spark, out, "hourly").select(*layout.names, "month")
    files = readers.read_month_files(spark, str(raw), "hourly", schema=layout)
    batch = readings.distinct_readings(files, "hourly")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert batch.count() == 5 + 2 and files.count() == 12


def test_copies_within_a_stream_of_several_batches(spark, tmp_path):
    """Two files with the same readings, in two micro-batches of one query."""
    head = "WBAN,YearMonthDay,Time,DryBulbFarenheit"
    for name in ("a", "b"):
        write(tmp_path / f"raw/{name}.txt", head, *ONCE, *KEYLESS)
    write(tmp_path / "raw/c.txt", head, "3011,20130201,30,50", ONCE[1])
    layout = readers.header_schema(spark, str(tmp_path / "raw/a.txt"), "hourly")
    stream = (spark.readStream.schema(layout).option("header", True).option("maxFilesPerTrigger", 1).csv(str(tmp_path / "raw")))
    query = (readings.distinct_stream(stream, "hourly").writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination()
    assert query.exception() is None
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = readings.distinct_readings(spark.read.schema(layout).option("header", True).csv(str(tmp_path / "raw")), "hourly")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert streamed.count() == 5 + 4


def test_batch_keeps_the_least_row_and_combines_in_the_tasks(spark):
    rows = spark.createDataFrame([(1, 20130101, 30, "9"), (1, 20130101, 30, "5"), (1, 20130101, 30, None),
                                  (1, 20130101, None, "1"), (1, 20130101, None, "1")], HOURLY)
    got = readings.distinct_readings(rows, "hourly")
    assert sorted(map(str, got.collect())) == sorted(map(str, [r for r in rows.collect() if r.Time is None
                                                                or r.DryBulbFarenheit is None]))
    assert [tuple(r) for r in readings.duplicate_counts(rows, "hourly").collect()] == [(1, 20130101, 30, 3)]
    plan = readings.distinct_readings(rows, "hourly")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert readings.distinct_readings(rows.limit(0), "hourly").count() == 0


def test_time_of_a_reading(spark):
    row = spark.createDataFrame([(1, 20130102, 1530, "1"), (1, 99, 1530, "1")], HOURLY).select(
        F.date_format(readings.read_at("hourly"), "yyyy-MM-dd HH:mm").alias("t")).collect()
    assert [r.t for r in row] == ["2013-01-02 15:30", None]


# ------------------------------------------------------------- manifest ----

def jobs(spark):
    tracker = spark.sparkContext.statusTracker()
    return set(tracker.getJobIdsForGroup(None))


def layout_schemas():
    return {k: schemas.by_month(schemas.LAYOUTS[k]) if k != "station" else schemas.STATION
            for k in ("daily", "hourly", "monthly", "station")}


def test_planning_runs_no_job(spark, tmp_path):
    root = str(tmp_path / "layer")
    sinks.write_tables(fixtures.load(spark, "/root/testdata/sf0.001"), root)
    found = manifest.write(spark, root)
    station = fixtures.load(spark, "/root/testdata/sf0.001").station
    assert found["station"]["rows"] == found["station"]["stations"] == station.count()
    assert found["monthly"]["rows"] == sum(found["monthly"]["months"].values())

    before = jobs(spark)
    tables = manifest.load(spark, root, layout_schemas())
    built = [q.station_metric_avg(tables, "CO", 1, 12), q.station_metric_avg_by_state_month(tables),
             q.hourly_profile_by_state(tables, None), q.metric_extrema_by_state(tables, 1, 3, "Tavg"),
             q.unreliable_stations(tables, 1, 6, "CO")]
    assert jobs(spark) == before
    assert "BroadcastHashJoin" in built[1]._jdf.queryExecution().executedPlan().toString()
    assert built[1].count() > 0 and jobs(spark) != before
    # without it the dimension is counted while planning
    before = jobs(spark)
    q.station_metric_avg_by_state_month(readers.load_partitioned(spark, root))
    assert jobs(spark) != before


def test_a_manifest_of_other_files_proves_nothing(spark, tmp_path):
    root, tables = str(tmp_path / "layer"), fixtures.load(spark, "/root/testdata/sf0.001")
    sinks.write_tables(tables, root)
    assert manifest.read(spark, root) == {} and manifest.proven(spark, root, "station") is None
    manifest.write(spark, root)
    assert manifest.proven(spark, root, "station")["stations"] == tables.station.count()
    sinks.write_parquet(tables.station.unionByName(tables.station.withColumn("WBAN", F.col("WBAN") + 1000)), f"{root}/station")
    assert manifest.proven(spark, root, "station") is None
    assert "station" not in manifest.load(spark, root, layout_schemas())._rows
    assert clean.MISSING == "M"
