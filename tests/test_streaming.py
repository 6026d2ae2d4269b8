"""Incremental ingest: each month file is loaded exactly once, re-runs add only new files."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from stationspark.plans import queries as q
from stationspark.sources import readers, schemas
from stationspark.streaming import ingest

MONTHLY = T.StructType([T.StructField("WBAN", T.IntegerType()), T.StructField("YearMonth", T.IntegerType()),
                        T.StructField("AvgTemp", T.StringType())])


def _month(root, m, temps):
    d = root / f"2013{m:02d}"
    d.mkdir()
    body = "".join(f"{w},2013{m:02d},{t}\n" for w, t in temps)
    (d / "monthly.txt").write_text("WBAN,YearMonth,AvgTemp\n" + body)
    (d / "station.txt").write_text("WBAN|State|Location|Latitude|Longitude\n03011|CO|X|1.0|2.0\n00007|UT|Y|3.0|4.0\n")


def test_ingest_is_incremental_and_exactly_once(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", tmp_path / "out", tmp_path / "ckpt"
    raw.mkdir()
    _month(raw, 1, [("03011", "40"), ("00007", "M")])
    _month(raw, 2, [("03011", "50")])
    layouts = {"monthly": MONTHLY, "station": schemas.STATION}
    first = ingest.ingest_available(spark, str(raw), str(out), layouts, str(ckpt))
    assert first == {"monthly": 3, "station": 4}

    again = ingest.ingest_available(spark, str(raw), str(out), layouts, str(ckpt))
    assert again == {"monthly": 0, "station": 0}

    _month(raw, 3, [("03011", "60"), ("00007", "70")])
    third = ingest.ingest_available(spark, str(raw), str(out), {"monthly": MONTHLY}, str(ckpt))
    assert third == {"monthly": 2}

    monthly = readers.read_partitioned(spark, str(out), "monthly")
    got = sorted((r.WBAN, r.month, r.AvgTemp) for r in monthly.collect())
    assert got == [(7, 1, "M"), (7, 3, "70"), (3011, 1, "40"), (3011, 2, "50"), (3011, 3, "60")]

    tables = readers.load_partitioned(spark, str(out), kinds=("monthly",))
    assert sorted(r.WBAN for r in tables.station.collect()) == [7, 3011]
    assert q.station_metric_avg(tables, "CO", 1, 3).first().value == 50.0


def test_reordered_header_fails_instead_of_shifting_columns(spark, tmp_path):
    raw = tmp_path / "raw"
    for m, header, row in ((1, "WBAN,YearMonth,AvgTemp", "3011,201301,40"), (2, "AvgTemp,WBAN,YearMonth", "50,3011,201302")):
        (raw / f"2013{m:02d}").mkdir(parents=True)
        (raw / f"2013{m:02d}" / "monthly.txt").write_text(f"{header}\n{row}\n")
    with pytest.raises(StreamingQueryException):
        ingest.ingest_available(spark, str(raw), str(tmp_path / "out"), {"monthly": MONTHLY})


def test_years_stay_apart_and_progress_lies_with_the_output(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    for ym, temp in (("201301", "40"), ("201401", "90")):
        (raw / ym).mkdir(parents=True)
        (raw / ym / "monthly.txt").write_text(f"WBAN,YearMonth,AvgTemp\n3011,{ym},{temp}\n")
        (raw / ym / "station.txt").write_text("WBAN|State|Location|Latitude|Longitude\n3011|CO|X|1.0|2.0\n")
    assert ingest.ingest_available(spark, str(raw), str(out)) == {"monthly": 2, "station": 2}
    for year, temp in ((2013, 40.0), (2014, 90.0)):
        t = readers.load_partitioned(spark, str(out), year=year)
        assert q.station_metric_avg(t, "CO", 1, 12).first().value == temp
    assert (out / "_checkpoints" / "monthly").is_dir()
    # another output starts anew
    assert ingest.ingest_available(spark, str(raw), str(tmp_path / "out_2"))["monthly"] == 2
    assert ingest.ingest_available(spark, str(raw), str(out)) == {"monthly": 0, "station": 0}
