import pytest

from stationspark.functions import params
from stationspark.plans import queries as q
from stationspark.sources import catalog


def test_month_checks():
    assert params.check_month(1) == 1
    assert params.check_month_range(2, 5) == (2, 5)
    for bad in (0, 13, -1, "3", 2.0, True, None):
        with pytest.raises(ValueError):
            params.check_month(bad)
    with pytest.raises(ValueError):
        params.check_month_range(5, 2)


def test_state_checks():
    assert params.check_state("CA", known=catalog.STATES) == "CA"
    for bad in ("", "  ", None, 3):
        with pytest.raises(ValueError):
            params.check_state(bad)
    with pytest.raises(ValueError):
        params.check_state("DC", known=catalog.STATES)


def test_metric_checks(tables):
    assert params.check_metric(tables.monthly, "monthly", "AvgTemp") == "AvgTemp"
    with pytest.raises(ValueError):
        params.check_metric(tables.monthly, "monthly", "Tavg")          # not a monthly metric
    with pytest.raises(ValueError):
        params.check_metric(tables.monthly, "monthly", "AvgMaxTemp")    # in catalog, not in data
    assert params.is_numeric(tables.station, "Latitude")
    assert not params.is_numeric(tables.monthly, "AvgTemp")


def test_queries_reject_bad_parameters(tables):
    with pytest.raises(ValueError):
        q.station_metric_avg(tables, "", 1, 2)
    with pytest.raises(ValueError):
        q.station_metric_avg(tables, "NATION_3", 5, 2)
    with pytest.raises(ValueError):
        q.hourly_profile(tables, "NATION_3", 0)
    with pytest.raises(ValueError):
        q.metric_extrema(tables, 4, "NATION_3", 1, "Tavg")
    with pytest.raises(ValueError):
        q.metric_extrema(tables, "daily", "NATION_3", 1, "NoSuchMetric")
    with pytest.raises(ValueError):
        q.unreliable_stations(tables, 1, 2, k=0)
    no_dew = type(tables)(station=tables.station, daily=tables.daily.drop("DewPoint"))
    with pytest.raises(ValueError, match="DewPoint"):
        q.agri_days(no_dew, 6)


def test_catalog_values():
    assert len(catalog.STATES) == 50 and "DC" not in catalog.STATES
    assert [len(catalog.METRICS[k]) for k in ("daily", "hourly", "monthly")] == [19, 12, 26]
    assert catalog.kind_of(1) == "daily" and catalog.kind_of("2") == "hourly"
    assert catalog.kind_of("Monthly") == "monthly"
    assert catalog.catalog_kind("1") == "daily" and catalog.catalog_kind("9") == "monthly"
    assert catalog.unit_of("daily", "PrecipTotal") == "inches"
    assert catalog.unit_of("hourly", "PrecipTotal") is None


def test_catalog_frames(spark):
    assert q.metric_catalog(spark, "2").count() == 12
    assert q.metric_catalog(spark, "x").count() == 26
    assert catalog.metric_catalog(spark).count() == 57
    assert catalog.state_dim(spark).count() == 50
    assert sorted(r.kind for r in catalog.kind_dim(spark).collect()) == ["daily", "hourly", "monthly"]
