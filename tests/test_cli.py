"""Command line over the distributed file layout: ingest, then query the Parquet layer."""

import json
import os

import pytest

from stationspark.__main__ import main
from stationspark.session import local_path, scratch_path


def _month(root, m):
    d = root / f"2013{m:02d}"
    d.mkdir()
    (d / "station.txt").write_text("WBAN|State|Location|Latitude|Longitude\n"
                                   "03011|CO|TELLURIDE|37.95|-107.9\n14739|MA|BOSTON|42.36|-71.01\n")
    (d / "monthly.txt").write_text(f"WBAN,YearMonth,AvgTemp\n03011,2013{m:02d},{30 + m}\n14739,2013{m:02d},M\n")
    (d / "daily.txt").write_text("WBAN,YearMonthDay,Tavg,TavgFlag,Depart,DewPoint,WetBulb,Max5Speed,"
                                 "PrecipTotal,CodeSum\n"
                                 f"03011,2013{m:02d}01,61,s,7,45,50,25,0.00, \n"
                                 f"14739,2013{m:02d}01,M,s,M,M,M,M,  T,RA\n")
    (d / "hourly.txt").write_text("WBAN,YearMonthDay,Time,DryBulbFarenheit\n"
                                  f"03011,2013{m:02d}01,0153,40\n03011,2013{m:02d}01,0200,99\n")


def test_cli_month_files_ingest_and_partitioned(spark, tmp_path, capsys):
    raw = tmp_path / "dataset"
    raw.mkdir()
    for m in (1, 2, 3):
        _month(raw, m)
    assert main(["--data", str(raw), "avg", "CO", "1", "3"]) == 0
    assert "32.0" in capsys.readouterr().out                       # (31 + 32 + 33) / 3

    out_root = str(tmp_path / "layer")
    assert main(["--data", str(raw), "ingest", out_root]) == 0
    assert "'daily': 6" in capsys.readouterr().out

    records = scratch_path(spark, "cli-out")
    assert main(["--data", out_root, "--layout", "partitioned", "--out", records,
                 "unreliable", "1", "3"]) == 0
    files = [f for f in os.listdir(local_path(records)) if f.endswith(".json")]
    rows = sorted((json.loads(x)["WBAN"], json.loads(x)["suspicious_count"])
                  for f in files for x in open(os.path.join(local_path(records), f)))
    assert rows == [(3011, 3), (14739, 3)]            # one "s" flag per station and month

    from stationspark.sources import readers
    layer = readers.load_partitioned(spark, out_root)
    assert layer.station.count() == 2                              # one row per station, not per month
    assert main(["--data", out_root, "--layout", "partitioned", "hourly", "CO", "2"]) == 0
    shown = capsys.readouterr().out
    assert "|1   |1:00 |40.0 |" in shown and "|2   |2:00 |0.0  |" in shown
    assert main(["--data", str(raw), "catalog", "2"]) == 0
    assert "DryBulbFarenheit" in capsys.readouterr().out


def test_cli_every_question(spark, tmp_path, capsys):
    raw = tmp_path / "dataset"
    raw.mkdir()
    for m in (1, 2):
        _month(raw, m)
    data = ["--data", str(raw)]
    commands = [
        (["avg", "CO", "1", "2", "--by-state-month"], "CO"),
        (["monthly-temp", "1"], "01"),
        (["monthly-temp"], "02"),
        (["anomalous", "1"], "01/01/2013"),
        (["agri", "2", "--wban", "3011"], "01/02/2013"),
        (["stations", "CO"], "3011"),
        (["hourly", "CO", "1", "--include-on-hour"], "2:00"),
        (["extrema", "daily", "CO", "1", "Tavg"], "TELLURIDE"),
        (["extrema", "3", "CO", "2", "AvgTemp"], "32.0"),
        (["unreliable", "1", "2", "--state", "MA", "-k", "1"], "14739"),
    ]
    for args, expected in commands:
        assert main(data + args) == 0
        assert expected in capsys.readouterr().out, args


def test_cli_kept_layers(spark, tmp_path, capsys):
    raw, layer = tmp_path / "dataset", str(tmp_path / "layer")
    raw.mkdir()
    for m in (1, 2):
        _month(raw, m)
    assert main(["--data", str(raw), "ingest", "--corrections", layer]) == 0
    (raw / "201302" / "monthly.2.txt").write_text("WBAN,YearMonth,AvgTemp\n03011,201302,50\n")
    assert main(["--data", str(raw), "ingest", "--corrections", layer]) == 0
    capsys.readouterr()
    for layout in ("partitioned", "maintained"):
        data = ["--data", layer, "--layout", layout]
        for args, expected in (
                (["avg", "CO", "1", "2"], "40.5"), (["avg", "CO", "1", "2", "--by-state-month"], "50.0"),
                (["monthly-temp", "2"], "10.0"), (["hourly", "CO", "1"], "|40.0"),
                (["extrema", "daily", "CO", "1", "Tavg"], "TELLURIDE"), (["unreliable", "1", "2", "-k", "1"], "|3011|2 "),
                (["unreliable", "1", "2", "--by-state"], "|MA   |1   |14739|2")):
            assert main(data + args) == 0
            assert expected in capsys.readouterr().out, (layout, args)
    data = ["--data", layer, "--layout", "partitioned"]
    assert main(data + ["avg", "CO", "2", "2", "--unit", "°C"]) == 0
    assert "10.0" in capsys.readouterr().out
    assert main(data + ["extrema", "daily", "CO", "1", "Max5Speed", "--unit", "km/h"]) == 0
    assert "40.23" in capsys.readouterr().out
    assert main(data + ["partials", str(tmp_path / "more")]) == 0
    assert main(data + ["cluster", "hourly", str(tmp_path / "own"), "--rows-per-range", "2"]) == 0
    assert main(data + ["manifest"]) == 0
    assert os.path.exists(f"{layer}/_manifest.json") and os.path.isdir(tmp_path / "more" / "_partials" / "daily")
    with pytest.raises(SystemExit):
        main(["--data", layer, "--layout", "maintained", "agri", "1"])
