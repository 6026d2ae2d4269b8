"""Property tests: random daily and hourly rows against a plain-Python model of each question."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stationspark.plans import queries as q

STATIONS = [(w, "AA" if w % 2 else "BB", f"S{w}", float(w), -float(w)) for w in range(1, 7)]
TOKENS = ["M", "T", "  T", "", " 0.00", "0", "1.50", "5.7", "6", "21", "20", "60", "75", "40", "s", "-3"]
CODES = [None, " ", "TSRA", "RA", "BR TS"]

row = st.fixed_dictionaries({
    "WBAN": st.integers(1, 8),                      # 7 and 8 have no station
    "YearMonthDay": st.integers(1, 28).map(lambda d: 20130300 + d),
    "month": st.sampled_from([3, 3, 3, 4]),
    "Tavg": st.sampled_from(TOKENS), "TavgFlag": st.sampled_from(["s", " ", None]),
    "Depart": st.sampled_from(TOKENS), "DewPoint": st.sampled_from(TOKENS),
    "DewPointFlag": st.sampled_from(["s", " "]), "WetBulb": st.sampled_from(TOKENS),
    "CodeSum": st.sampled_from(CODES), "PrecipTotal": st.sampled_from(TOKENS),
    "Max5Speed": st.sampled_from(TOKENS),
})

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def num(text):
    try:
        value = float(text) if text is not None else None
    except ValueError:
        return None
    return None if value is None or math.isnan(value) or math.isinf(value) else value


def gt(a, b):
    return None if a is None else a > b


def or3(a, b):
    if a is True or b is True:
        return True
    return None if a is None or b is None else False


@SETTINGS
@given(st.lists(row, max_size=40))
def test_anomalous_days_model(make_tables, rows):
    t = make_tables(STATIONS, daily=rows)
    got = sorted((r.YearMonthDay, r.WBAN) for r in q.anomalous_days(t, 3).collect())
    want = sorted((r["YearMonthDay"], r["WBAN"]) for r in rows if r["month"] == 3
                  and gt(num(r["Depart"]), 5) is True
                  and or3(gt(num(r["Max5Speed"]), 20), gt(num(r["PrecipTotal"]), 1)) is True)
    assert got == want


@SETTINGS
@given(st.lists(row, max_size=40))
def test_agri_days_model(make_tables, rows):
    t = make_tables(STATIONS, daily=rows)

    def ok(r):
        tavg, dew, rain = num(r["Tavg"]), num(r["DewPoint"]), num(r["PrecipTotal"])
        return (r["month"] == 3 and tavg is not None and 60 <= tavg <= 75 and dew is not None
                and 40 <= dew <= 60 and r["CodeSum"] is not None and "TS" not in r["CodeSum"]
                and rain == 0)

    got = sorted((r.WBAN, r.YearMonthDay) for r in q.agri_days(t, 3).collect())
    assert got == sorted((r["WBAN"], r["YearMonthDay"]) for r in rows if ok(r))


@SETTINGS
@given(st.lists(row, max_size=40))
def test_suspect_counts_model(make_tables, rows):
    t = make_tables(STATIONS, daily=rows)
    text_cols = ["Tavg", "TavgFlag", "Depart", "DewPoint", "DewPointFlag", "WetBulb", "CodeSum",
                 "PrecipTotal", "Max5Speed"]
    counts: dict[int, int] = {}
    for r in rows:
        if 3 <= r["month"] <= 4:
            counts[r["WBAN"]] = counts.get(r["WBAN"], 0) + sum(r[c] == "s" for c in text_cols)
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    got = [(r.WBAN, r.suspicious_count) for r in q.unreliable_stations(t, 3, 4, k=3).collect()]
    assert got == want
    in_aa = {w for w, s, *_ in STATIONS if s == "AA"}
    want_aa = sorted(((w, c) for w, c in counts.items() if w in in_aa), key=lambda kv: (-kv[1], kv[0]))
    got_aa = [(r.WBAN, r.suspicious_count) for r in q.unreliable_stations(t, 3, 4, state="AA").collect()]
    assert got_aa == want_aa[:10]


@SETTINGS
@given(st.lists(row, max_size=40))
def test_extrema_and_mean_model(make_tables, rows):
    t = make_tables(STATIONS, daily=rows)
    in_aa = {w for w, s, *_ in STATIONS if s == "AA"}
    vals = [(num(r["Tavg"]), r["WBAN"]) for r in rows
            if r["month"] == 3 and r["WBAN"] in in_aa and num(r["Tavg"]) is not None]
    got = {r.which: (r.WBAN, r.value) for r in q.metric_extrema(t, "daily", "AA", 3, "Tavg").collect()}
    if not vals:
        assert got == {"min": (None, None), "max": (None, None)}
    else:
        lo = min(vals)
        hi = min(vals, key=lambda vw: (-vw[0], vw[1]))
        assert got == {"min": (lo[1], round(lo[0], 2)), "max": (hi[1], round(hi[0], 2))}
    for rows_left in (None, 10):
        mean = q.station_metric_avg(t, "AA", 3, 3, metric="Tavg", kind="daily",
                                    broadcast_rows=rows_left).first().value
        if vals:
            assert math.isclose(mean, sum(v for v, _ in vals) / len(vals), rel_tol=1e-12)
        else:
            assert mean is None


hour_row = st.tuples(st.integers(1, 8),                                   # WBAN (7, 8: no station)
                     st.sampled_from([0, 1, 59, 100, 101, 159, 200, 1230, 2300, 2359, 2400, 2459]),
                     st.sampled_from(TOKENS),
                     st.sampled_from([1, 1, 2]))


@SETTINGS
@given(st.lists(hour_row, max_size=40))
def test_hourly_profile_model(make_tables, rows):
    t = make_tables(STATIONS, hourly=[(w, 20130101, tm, v, m) for w, tm, v, m in rows])
    in_aa = {w for w, s, *_ in STATIONS if s == "AA"}
    sums: dict[int, list[float]] = {}
    for w, tm, v, m in rows:
        if m == 1 and w in in_aa and 0 < tm < 2400 and tm % 100 != 0 and num(v) is not None:
            sums.setdefault(tm // 100, []).append(num(v))
    want = [(h, sum(sums[h]) / len(sums[h]) if h in sums else 0.0) for h in range(24)]
    for bound in (10, None):
        got = [(r.hour, r.value) for r in q.hourly_profile(t, "AA", 1, broadcast_rows=bound).collect()]
        assert [h for h, _ in got] == list(range(24))
        assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for (_, a), (_, b) in zip(got, want))
