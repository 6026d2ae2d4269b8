"""Figures of FIXTURES.md section 3 over the sf0.01 driver tables."""

from stationspark.plans import queries as q


def test_view_row_counts(tables):
    assert [tables.station.count(), tables.daily.count(), tables.hourly.count(), tables.monthly.count()] \
        == [100, 60000, 20000, 15000]


def test_q1(tables):
    row = q.station_metric_avg(tables, "NATION_3", 2, 5).first()
    assert (row.metric, row.value, row.unit) == ("AvgTemp", 55.03809523809524, "°F")
    assert q.station_metric_avg_by_state_month(tables).count() == 300


def test_q2(tables):
    assert q.monthly_avg_temperature(tables, 1).first().avg_c == 12.519841269841269
    assert q.monthly_avg_temperature(tables, 1, offset=31.0).first().avg_c == 13.075396825396824
    assert q.monthly_avg_temperature(tables).count() == 12


def test_q3_q4_q5(tables):
    assert q.anomalous_days(tables, 3).count() == 1271
    assert q.agri_days(tables, 6).count() == 59
    assert q.agri_days(tables, 6, wban=1).count() == 1
    assert sorted(r.WBAN for r in q.station_ids(tables, "NATION_3").collect()) == [51, 68, 70]


def test_q6(tables):
    rows = q.hourly_profile(tables, "NATION_3", 1).collect()
    assert [r.hour for r in rows] == list(range(24))
    assert [r.value for r in rows[:4]] == [64.25, 50.4, 59.333333333333336, 32.5]
    assert q.hourly_profile_by_state(tables, 1).count() == 600       # 25 states, every hour
    assert q.hourly_profile_by_state(tables, 1).filter("value <> 0").count() <= 594
    assert q.hourly_profile_by_state(tables, None).filter("value <> 0").select("month").distinct().count() == 12


def test_q7(tables):
    rows = {r.which: r for r in q.metric_extrema(tables, "daily", "NATION_3", 3, "Tavg").collect()}
    assert (rows["min"].WBAN, rows["min"].value) == (68, 41.0)
    assert (rows["max"].WBAN, rows["max"].value) == (70, 89.0)
    assert rows["min"].difference == 48.0


def test_q8(tables):
    top = [(r.WBAN, r.suspicious_count) for r in q.unreliable_stations(tables, 1, 6).collect()]
    assert top == [(95, 32), (14, 30), (46, 29), (78, 29), (34, 27), (76, 27), (77, 27), (94, 27),
                   (21, 26), (41, 26)]
    state = [(r.WBAN, r.suspicious_count) for r in
             q.unreliable_stations(tables, 1, 6, state="NATION_3").collect()]
    assert state == [(70, 24), (68, 17), (51, 13)]
