"""Different plans for the same question must give the same rows."""

from pyspark.sql import functions as F

from stationspark.functions import clean
from stationspark.operators import stations as st
from stationspark.plans import queries as q

STATE = "NATION_3"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_broadcast_and_per_station_paths_agree(tables):
    for build in (lambda b: q.station_metric_avg(tables, STATE, 2, 5, broadcast_rows=b),
                  lambda b: q.station_metric_avg_by_state_month(tables, broadcast_rows=b),
                  lambda b: q.hourly_profile(tables, STATE, 1, broadcast_rows=b),
                  lambda b: q.hourly_profile(tables, STATE, 1, wban=68, broadcast_rows=b),
                  lambda b: q.hourly_profile_by_state(tables, 1, broadcast_rows=b),
                  lambda b: q.unreliable_stations(tables, 1, 6, state=STATE, broadcast_rows=b)):
        assert rows(build(st.DEFAULT_BROADCAST_ROWS)) == rows(build(None))


def test_grouped_forms_match_single_forms(tables):
    grouped = q.station_metric_avg_by_state_month(tables, 2, 2).filter(F.col("State") == STATE).first()
    single = q.station_metric_avg(tables, STATE, 2, 2).first()
    assert grouped.value == single.value

    by_state = {r.hour: r.value for r in
                q.hourly_profile_by_state(tables, 1).filter(F.col("State") == STATE).collect()}
    profile = {r.hour: r.value for r in q.hourly_profile(tables, STATE, 1).collect()}
    assert all(profile[h] == v for h, v in by_state.items())
    assert all(v == 0.0 for h, v in profile.items() if h not in by_state)

    ext = {r.which: (r.WBAN, r.value) for r in
           q.metric_extrema_by_state(tables, "daily", 3, "Tavg").filter(F.col("State") == STATE).collect()}
    single_ext = {r.which: (r.WBAN, r.value) for r in
                  q.metric_extrema(tables, "daily", STATE, 3, "Tavg").collect()}
    assert ext == single_ext


def test_one_group_by_equals_24_filters(tables):
    """The original asked 24 filtered means; one aggregation answers them all."""
    profile = {r.hour: r.value for r in q.hourly_profile(tables, STATE, 1).collect()}
    ids = [r.WBAN for r in q.station_ids(tables, STATE).collect()]
    base = tables.hourly.filter((F.col("month") == 1) & F.col("WBAN").isin(ids))
    for i in (0, 5, 17, 23):
        one = base.filter((F.col("Time") > i * 100) & (F.col("Time") < (i + 1) * 100)) \
            .agg(F.avg(clean.metric("DryBulbFarenheit"))).first()[0]
        assert profile[i] == (one if one is not None else 0.0)


def test_semi_join_equals_inner_on_unique_ids(tables):
    ids = st.in_state(tables.station, STATE)
    semi = st.keep_stations(tables.daily, ids)
    inner = tables.daily.join(ids.select("WBAN"), "WBAN", "inner")
    assert semi.count() == inner.count()
    assert rows(semi.select("WBAN", "YearMonthDay")) == rows(inner.select("WBAN", "YearMonthDay"))


def test_semi_join_does_not_fan_out_on_repeated_ids(tables):
    ids = st.in_state(tables.station, STATE)
    doubled = ids.unionByName(ids)
    assert st.keep_stations(tables.daily, doubled).count() == st.keep_stations(tables.daily, ids).count()


def test_suspect_count_top_k_is_prefix_of_full_ranking(tables):
    full = q.suspect_counts(tables, 1, 6).orderBy(F.desc("suspicious_count"), "WBAN").collect()
    top = q.unreliable_stations(tables, 1, 6, k=10).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in full[:10]]


def test_month_keyed_grouped_forms_match_single_month(tables):
    by_month = q.hourly_profile_by_state(tables, None).filter(F.col("month") == 1).drop("month")
    assert rows(by_month) == rows(q.hourly_profile_by_state(tables, 1))
    ext_all = q.metric_extrema_by_state(tables, "monthly", None, "AvgTemp").filter(F.col("month") == 3)
    assert rows(ext_all.drop("month")) == rows(q.metric_extrema_by_state(tables, "monthly", 3, "AvgTemp"))
    avg_all = q.station_metric_avg_by_state_month(tables).filter((F.col("State") == STATE) & (F.col("month") == 4))
    assert avg_all.first().value == q.station_metric_avg(tables, STATE, 4, 4).first().value


def test_counts_by_month_match_single_months(tables):
    by_month = {r.month: r.n_days for r in q.anomalous_days_count(tables, None).collect()}
    for m in (1, 3, 12):
        assert by_month.get(m, 0) == q.anomalous_days_count(tables, m).first().n_days
    agri = {r.month: r.n_days for r in q.agri_days_count(tables, None).collect()}
    assert agri.get(6, 0) == q.agri_days_count(tables, 6).first().n_days == 59
    assert q.anomalous_days(tables, None).count() == sum(by_month.values())


def test_complete_grouped_profile_matches_single_profiles(tables):
    for rows_bound in (st.DEFAULT_BROADCAST_ROWS, None):
        full = q.hourly_profile_by_state(tables, 1, broadcast_rows=rows_bound)
        n_states = tables.station.select("State").distinct().count()
        assert full.count() == 24 * n_states
        mine = sorted((r.hour, r.label, r.value) for r in full.filter(F.col("State") == STATE).collect())
        single = sorted((r.hour, r.label, r.value) for r in q.hourly_profile(tables, STATE, 1).collect())
        assert mine == single
