"""As-of station rows, the clustered layer, top-k in every group, unit algebra."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stationspark.functions import units
from stationspark.operators import aggregates as agg
from stationspark.operators import asof
from stationspark.plans import converted
from stationspark.plans import queries as q
from stationspark.sources import catalog, clustered, fixtures

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- as-of ----

def versions(spark):
    rows = [(1, 1, "CO", "a"), (1, 5, "UT", "b"), (2, 3, "CO", None), (3, 1, "CO", "c"), (3, 1, "AZ", "d"),
            (1, 9, "UT", "z")]
    return asof.station_versions(spark.createDataFrame(rows, "WBAN int, month int, State string, Location string"))


def test_each_row_gets_the_version_of_its_month(spark):
    facts = spark.createDataFrame([(w, m, i) for i, (w, m) in enumerate(
        [(1, 1), (1, 4), (1, 5), (1, 5), (1, 12), (2, 2), (2, 3), (2, 7), (3, 1), (4, 1), (None, 3)])],
        "WBAN int, month int, reading int")
    got = asof.attach_valid_station(facts, versions(spark), ("State", "Location"))
    assert sorted(map(tuple, got.select("reading", "State", "Location").collect())) == [
        (0, "CO", "a"), (1, "CO", "a"), (2, "UT", "b"), (3, "UT", "b"), (4, "UT", "z"), (6, "CO", None), (7, "CO", None),
        (8, "CO", "c")]
    left = asof.attach_valid_station(facts, versions(spark), how="left")
    assert left.count() == 11 and left.filter("State IS NULL").count() == 3
    assert asof.attach_valid_station(facts, versions(spark).limit(0)).count() == 0


def test_moves_are_seen_once(spark):
    assert [tuple(r) for r in asof.moved_stations(versions(spark)).collect()] == [(1, 5, "CO", "UT")]


def test_no_row_of_facts_is_compared_by_inequality(spark):
    tables, own = fixtures.load(spark, SF), fixtures.station_versions(spark, SF)
    for df in (asof.attach_valid_station(tables.monthly, own), asof.station_metric_avg_by_state_month(tables, own)):
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        # what the window sorts was aggregated to stations and months before it was shuffled
        assert plan.count("Window") == 1 and "HashAggregate(keys=[WBAN" in plan


# ------------------------------------------------------------ clustered ----

def rows_read(df):
    """Rows that the scans handed on after row groups were passed over."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


def test_rows_are_dealt_to_ranges_some_at_a_time(spark, tmp_path, monkeypatch):
    """However large one task's input, the tasks that deal it read a bounded number of rows."""
    one_task = spark.range(0, 90_000, 1, 1).select(
        (F.col("id") % 50).cast("int").alias("WBAN"), F.when(F.col("id") % 7 > 0, F.lit(1)).alias("month"), "id")
    small = clustered.in_small_files(one_task, 1_000)
    rows = [r["count"] for r in small.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 90_000 and max(rows) <= 32 * 1_000
    read = []
    monkeypatch.setattr(clustered, "in_small_files", lambda df: read.append(small) or small)
    own = clustered.read(spark, clustered.write(one_task, str(tmp_path / "own"), ranges=5))
    assert read and own.count() == 90_000 and own.select("id").distinct().count() == 90_000
    assert own.filter("month IS NULL").count() == one_task.filter("month IS NULL").count()


def test_station_filter_passes_over_row_groups(spark, tmp_path):
    # a third of all rows are one station's
    df = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, 77).otherwise((F.col("id") * 7919 % 400).cast("int")).cast("int").alias("WBAN"),
        (F.floor(F.col("id") / 40_000) + 1).cast("int").alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("text"), "id")
    path = clustered.write(df, str(tmp_path / "own"), ranges=12, row_group_bytes=128 << 10)
    own = clustered.read(spark, path)
    one = clustered.of_station(own, 200)
    assert one.count() == df.filter("WBAN = 200").count() > 0
    assert rows_read(one) < 120_000 * 0.1
    df.write.partitionBy("month").parquet(str(tmp_path / "plain"))
    assert rows_read(clustered.of_station(spark.read.parquet(str(tmp_path / "plain")), 200)) == 120_000
    # no file, so no task, holds a whole month, nor all rows of the hot station
    for month in (1, 2, 3):
        sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/month={month}/*.parquet")]
        assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes) and sum(sizes) == 40_000
    hot = own.filter("WBAN = 77").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(hot) >= 4
    # the Bloom filter passes over a station that lies inside the range of ids but has no row
    meta = pq.ParquetFile(glob.glob(f"{path}/month=1/*.parquet")[0]).metadata
    assert meta.num_row_groups > 1
    assert rows_read(clustered.of_station(own, 100_000)) == 0


# ---------------------------------------------------------------- top-k ----

def test_top_k_of_every_state(spark, make_tables):
    station = [(w, "CO" if w <= 6 else "UT", "x", 0.0, 0.0) for w in range(1, 9)]
    daily = [{"WBAN": w, "YearMonthDay": 20130101 + d, "TavgFlag": "s" if d < w % 4 else " ", "month": 1}
             for w in range(1, 9) for d in range(4)]
    t = make_tables(station=station, daily=daily)
    got = sorted(map(tuple, q.unreliable_stations_by_state(t, 1, 12, k=3).collect()))
    assert got == [("CO", 1, 3, 3), ("CO", 2, 2, 2), ("CO", 3, 6, 2), ("UT", 1, 7, 3), ("UT", 2, 8, 0)]
    with pytest.raises(ValueError):
        q.unreliable_stations_by_state(t, 1, 12, k=0)


def test_partial_limit_before_the_shuffle(spark):
    plan = plan_of(q.unreliable_stations_by_state(fixtures.load(spark, SF), 1, 6, k=3))
    final, partial = plan.index("row_number(), 3, Final"), plan.index("row_number(), 3, Partial")
    assert final < plan.index("Exchange hashpartitioning(State", final) < partial


def test_top_k_per_group_ties(spark):
    df = spark.createDataFrame([("a", 2, 5), ("a", 1, 5), ("a", 3, 9), ("b", 1, None)], "g string, WBAN int, n int")
    got = agg.top_k_per_group(df, ("g",), 2, "n").select("g", "rank", "WBAN").collect()
    assert sorted(map(tuple, got)) == [("a", 1, 3), ("a", 2, 1), ("b", 1, 1)]


# ---------------------------------------------------------------- units ----

def test_every_catalog_unit_is_known():
    for kind, metrics in catalog.METRICS.items():
        for metric in metrics:
            assert units.unit_of(kind, metric).scale > 0


@pytest.mark.parametrize("value,a,b,want", [
    (212, "°F", "°C", 100.0), (32, "°F", "K", 273.15), (-40, "°C", "°F", -40.0), (1, "inches", "mm", 25.4),
    (1, "inches of mercury", "hPa", 33.86389), (10, "m/s", "km/h", 36.0), (1, "mph", "km/h", 1.609344),
    (50, "%", "1", 0.5), (18, "°F-days", "°C-days", 10.0), (1, "km/h", "m/s", 1 / 3.6), (5, "degrees", "°", 5.0)])
def test_conversions(value, a, b, want):
    scale, zero = units.factors(units.unit(a), units.unit(b))
    assert value * scale + zero == pytest.approx(want, abs=1e-9)


def test_mismatches_are_refused(spark):
    t = fixtures.load(spark, SF)
    for build in (lambda: converted.station_metric_avg(t, "NATION_3", 1, 2, "AvgTemp", "hPa"),
                  lambda: converted.metric_extrema(t, "daily", "NATION_3", 3, "Max5Speed", "mm"),
                  lambda: converted.metric_extrema_by_state(t, 1, 3, "Tavg", "furlongs"),
                  lambda: units.unit("m/parsec")):
        with pytest.raises(ValueError):
            build()


def test_a_difference_converts_without_its_zero(spark, make_tables):
    t = make_tables(station=[(1, "CO", "x", 0.0, 0.0), (2, "CO", "y", 0.0, 0.0)],
                    daily=[{"WBAN": 1, "Depart": "9", "Tavg": "50", "month": 1}, {"WBAN": 2, "Depart": "-9", "Tavg": "14", "month": 1}])
    depart = converted.metric_extrema(t, 1, "CO", 1, "Depart", "°C").collect()
    assert [(r.which, r.WBAN, r.value, r.difference, r.unit) for r in depart] == [
        ("min", 2, -5.0, 10.0, "°C"), ("max", 1, 5.0, 10.0, "°C")]
    tavg = converted.metric_extrema(t, 1, "CO", 1, "Tavg", "°C").collect()
    assert [(r.WBAN, r.value, r.difference) for r in tavg] == [(2, -10.0, 20.0), (1, 10.0, 20.0)]
    mean = converted.station_metric_avg(t, "CO", 1, 1, "Depart", "°C", "daily").first()
    assert (mean.value, mean.unit) == (0.0, "°C")
