"""Hand-made rows for the risky semantics: markers, thresholds, nulls, ties, empties."""

import pytest

from stationspark.plans import queries as q

STATIONS = [(1, "AA", "Alpha", 30.0, -80.0), (2, "AA", "Beta", 31.0, -81.0),
            (3, "BB", "Gamma", 32.0, -82.0), (4, "AA", "Delta", 33.0, -83.0)]


def day(wban, ymd, month=3, **metrics):
    row = {"WBAN": wban, "YearMonthDay": ymd, "month": month, "CodeSum": " ",
           "TavgFlag": " ", "DewPointFlag": " "}
    row.update(metrics)
    return row


def test_anomalous_thresholds_and_nulls(make_tables):
    t = make_tables(STATIONS, daily=[
        day(1, 20130301, Depart="5.7", Max5Speed="21", PrecipTotal="0.00"),   # fractional depart
        day(1, 20130302, Depart="6", Max5Speed="10", PrecipTotal="1.50"),     # fractional rain
        day(1, 20130303, Depart="7", Max5Speed="M", PrecipTotal="2.10"),      # null wind, rain wins
        day(1, 20130304, Depart="5", Max5Speed="30", PrecipTotal="2"),        # not above 5
        day(1, 20130305, Depart="-9", Max5Speed="30", PrecipTotal="2"),       # negative departure
        day(1, 20130306, Depart="M", Max5Speed="30", PrecipTotal="2"),        # missing departure
        day(1, 20130307, Depart="8", Max5Speed="20", PrecipTotal="  T"),      # neither branch
        day(2, 20130401, month=4, Depart="9", Max5Speed="40", PrecipTotal="3"),
    ])
    rows = q.anomalous_days(t, 3).orderBy("YearMonthDay").collect()
    assert [r.YearMonthDay for r in rows] == [20130301, 20130302, 20130303]
    assert rows[2].Max5Speed is None and rows[1].PrecipTotal == 1.5
    assert q.anomalous_days_count(t, 3).first().n_days == 3
    assert q.anomalous_days_formatted(t, 3).orderBy("date").first().date == "01/03/2013"


def test_agri_days_codes_and_trace(make_tables):
    good = dict(Tavg="65", DewPoint="50", PrecipTotal="0.00", WetBulb="55")
    t = make_tables(STATIONS, daily=[
        day(1, 20130601, month=6, **good),                                   # blank code: farming day
        day(1, 20130602, month=6, **{**good, "CodeSum": None}),              # null code: dropped
        day(1, 20130603, month=6, **{**good, "CodeSum": "BR TS"}),           # thunder
        day(1, 20130604, month=6, **{**good, "PrecipTotal": "  T"}),         # trace is not zero
        day(1, 20130605, month=6, **{**good, "Tavg": "75"}),                 # inclusive bounds
        day(2, 20130606, month=6, **{**good, "DewPoint": "40", "PrecipTotal": " 0.00"}),
        day(2, 20130607, month=6, **{**good, "Tavg": "59.9"}),
    ])
    assert sorted(r.YearMonthDay for r in q.agri_days(t, 6).collect()) == [20130601, 20130605, 20130606]
    assert q.agri_days(t, 6, null_code_is_clear=True).count() == 4
    assert [r.YearMonthDay for r in q.agri_days(t, 6, wban=2).collect()] == [20130606]
    assert sorted(r.WBAN for r in q.agri_days_stations(t, 6).collect()) == [1, 2]
    formatted = q.agri_days_formatted(t, 6, wban=2).first()
    assert formatted.date == "06/06/2013" and formatted.Tavg == 65.0


def test_extrema_fraction_ties_and_empty(make_tables):
    t = make_tables(STATIONS, daily=[
        day(1, 20130301, Tavg="29.87"), day(2, 20130301, Tavg="29.87"),      # tie at the minimum
        day(4, 20130302, Tavg="80"), day(2, 20130302, Tavg="80"),            # tie at the maximum
        day(1, 20130303, Tavg="M"), day(3, 20130301, Tavg="10"),             # other state
    ])
    rows = {r.which: r for r in q.metric_extrema(t, "daily", "AA", 3, "Tavg").collect()}
    assert (rows["min"].WBAN, rows["min"].value, rows["min"].Location) == (1, 29.87, "Alpha")
    assert (rows["max"].WBAN, rows["max"].value) == (2, 80.0)
    assert rows["min"].difference == rows["max"].difference == 80.0 - 29.87
    assert rows["max"].unit == "°F"
    empty = q.metric_extrema(t, "daily", "AA", 5, "Tavg").collect()
    assert sorted(r.which for r in empty) == ["max", "min"]
    assert all(r.WBAN is None and r.value is None for r in empty)
    grouped = {(r.State, r.which): r.WBAN for r in q.metric_extrema_by_state(t, "daily", 3, "Tavg").collect()}
    assert grouped == {("AA", "min"): 1, ("AA", "max"): 2, ("BB", "min"): 3, ("BB", "max"): 3}
    by_month = q.metric_extrema_by_state(t, "daily", None, "Tavg").collect()
    assert len(by_month) == 2 * 12 * 2                     # states, months, min and max
    assert {r.month for r in by_month if r.value is None} == set(range(1, 13)) - {3}
    assert {(r.State, r.which, r.WBAN) for r in by_month if r.month == 3} == {(s, w, i) for (s, w), i in grouped.items()}


def test_grouped_extrema_of_a_state_without_values(make_tables):
    t = make_tables(STATIONS, daily=[day(1, 20130301, Tavg="5"), day(3, 20130301, Tavg="M")])
    rows = {(r.State, r.which): (r.WBAN, r.value, r.difference) for r in
            q.metric_extrema_by_state(t, "daily", 3, "Tavg").collect()}
    assert rows[("BB", "min")] == rows[("BB", "max")] == (None, None, None)
    assert rows[("AA", "min")] == (1, 5.0, 0.0) and len(rows) == 4


def test_suspect_counts_ties_and_repeated_station(make_tables):
    stations = STATIONS + [(1, "AA", "Alpha again", 30.0, -80.0)]           # repeated id
    t = make_tables(stations, daily=[
        day(1, 20130101, month=1, TavgFlag="s", DewPointFlag="s"),
        day(2, 20130101, month=1, TavgFlag="s", Tavg="s"),
        day(3, 20130101, month=1, TavgFlag="s"),
        day(4, 20130101, month=1),
        day(9, 20130101, month=1, TavgFlag="s", DewPointFlag="s", CodeSum="s"),  # no station
        day(1, 20130301, month=3, TavgFlag="s"),                                # outside range
    ])
    top = [(r.WBAN, r.suspicious_count) for r in q.unreliable_stations(t, 1, 2, k=3).collect()]
    assert top == [(9, 3), (1, 2), (2, 2)]
    aa = [(r.WBAN, r.suspicious_count) for r in q.unreliable_stations(t, 1, 2, state="AA").collect()]
    assert aa == [(1, 2), (2, 2), (4, 0)]


def test_means_and_profile_on_empty_selection(make_tables):
    t = make_tables(STATIONS, monthly=[(1, 201301, "50", 1), (2, 201301, "M", 1), (9, 201301, "99", 1)],
                    hourly=[(1, 20130101, 53, "60", 1), (1, 20130101, 100, "99", 1),
                            (2, 20130101, 153, "  T", 1), (4, 20130101, 2359, "70", 1),
                            (3, 20130101, 230, "10", 1)])
    assert q.station_metric_avg(t, "AA", 1, 1).first().value == 50.0
    assert q.station_metric_avg(t, "AA", 2, 3).first().value is None
    assert q.station_metric_avg(t, "CA", 1, 1).collect()[0].value is None     # a state without data
    profile = {r.hour: r.value for r in q.hourly_profile(t, "AA", 1).collect()}
    assert len(profile) == 24 and profile[0] == 60.0 and profile[1] == 0.0 and profile[23] == 70.0
    assert sum(profile.values()) == 130.0
    with_on_hour = {r.hour: r.value for r in q.hourly_profile(t, "AA", 1, include_on_hour=True).collect()}
    assert with_on_hour[1] == 99.0
    empty = q.hourly_profile(t, "AA", 2).collect()
    assert [r.hour for r in empty] == list(range(24)) and {r.value for r in empty} == {0.0}
    assert [r.label for r in empty][:2] == ["0:00", "1:00"]
    by_state = {(r.State, r.hour): r.value for r in q.hourly_profile_by_state(t, 1).collect()}
    assert len(by_state) == 2 * 24
    assert {k: v for k, v in by_state.items() if v} == {("AA", 0): 60.0, ("AA", 23): 70.0, ("BB", 2): 10.0}
    keyed = q.hourly_profile_by_state(t, None).collect()
    assert len(keyed) == 2 * 12 * 24 and sum(r.value for r in keyed) == 140.0


def test_unknown_state_is_an_error(make_tables):
    t = make_tables(STATIONS, daily=[day(1, 20130301, Tavg="5")], monthly=[(1, 201301, "50", 1)],
                    hourly=[(1, 20130101, 53, "60", 1)])
    for ask in (lambda s: q.station_metric_avg(t, s, 1, 1), lambda s: q.station_ids(t, s),
                lambda s: q.hourly_profile(t, s, 1), lambda s: q.metric_extrema(t, "daily", s, 3, "Tavg"),
                lambda s: q.unreliable_stations(t, 1, 3, state=s)):
        for bad in ("ZZ", "", "aa"):
            with pytest.raises(ValueError):
                ask(bad)
        ask("AA"), ask("CA")                                # known: loaded, or one of the 50


def test_count_belongs_to_the_month_of_the_file(make_tables):
    hit = dict(Depart="9", Max5Speed="40", PrecipTotal="3")
    t = make_tables(STATIONS, daily=[day(1, 20130301, **hit), day(1, 20130401, month=3, **hit),
                                     day(1, 20130402, month=4, **hit)])
    by_month = {r.month: r.n_days for r in q.anomalous_days_count(t, None).collect()}
    assert by_month == {m: {3: 2, 4: 1}.get(m, 0) for m in range(1, 13)}
    assert [q.anomalous_days_count(t, m).first().n_days for m in (3, 4, 5)] == [2, 1, 0]
    assert {r.n_days for r in q.agri_days_count(t, None).collect()} == {0}


def test_monthly_avg_temperature(make_tables):
    t = make_tables(STATIONS, monthly=[(1, 201301, "50", 1), (2, 201301, "68", 1), (3, 201302, "M", 2)])
    rows = {r.month: r.avg_c for r in q.monthly_avg_temperature(t).collect()}
    assert rows == {1: (59.0 - 32.0) / 1.8, 2: None}
    one = q.monthly_avg_temperature(t, 1, offset=31.0).first()
    assert (one.month, one.month_label, one.avg_c) == (1, "01", (59.0 - 31.0) / 1.8)
    assert q.monthly_avg_temperature(t, 7).first().avg_c is None


def test_station_ids_distinct(make_tables):
    t = make_tables(STATIONS + [(1, "AA", "Alpha again", 30.0, -80.0)])
    assert sorted(r.WBAN for r in q.station_ids(t, "AA").collect()) == [1, 2, 4]


def test_grouped_mean_keeps_null_state_group_in_both_plans(make_tables):
    stations = STATIONS + [(7, None, "Nowhere", 0.0, 0.0), (8, None, "Nowhere 2", 0.0, 0.0)]
    t = make_tables(stations, monthly=[(1, 201301, "50", 1), (2, 201301, "70", 1), (7, 201301, "10", 1),
                                       (8, 201301, "20", 1), (3, 201301, "M", 1)])
    want = {("AA", 1): 60.0, (None, 1): 15.0, ("BB", 1): None}
    for bound in (250_000, None):
        got = {(r.State, r.month): r.value for r in
               q.station_metric_avg_by_state_month(t, 1, 1, broadcast_rows=bound).collect()}
        assert got == want
