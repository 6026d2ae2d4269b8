"""The public queries.  Each builds one plan and returns a DataFrame.

No function here runs an action on fact data; the caller collects, shows
or writes the result.  Grouped forms (``*_by_*``) answer every state,
month or hour in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.functions import clean, params
from stationspark.operators import aggregates as agg
from stationspark.operators import stations as st
from stationspark.sources import catalog
from stationspark.sources.schemas import PARTITION_COLUMN, SUSPECT_FLAGS, key_columns
from stationspark.sources.tables import WeatherTables

MONTH = PARTITION_COLUMN


def _known_state(tables: WeatherTables, state: str) -> str:
    """One of the 50 states, or a state that a loaded station has."""
    params.check_state(state)
    if state not in catalog.STATES and tables.has_state(state):
        return state
    return params.check_state(state, known=catalog.STATES)


def _months(df: DataFrame, month_start: int, month_end: int) -> DataFrame:
    """Inclusive month range; on a month-partitioned table this prunes partitions."""
    if month_start == month_end:
        return df.filter(F.col(MONTH) == F.lit(month_start))
    return df.filter(F.col(MONTH).between(F.lit(month_start), F.lit(month_end)))


# ---------------------------------------------------------------- Q1 -------

def _rounded(value: str, digits: int | None):
    return F.col(value) if digits is None else F.round(value, digits).alias(value)


def station_metric_avg(tables: WeatherTables, state: str, month_start: int, month_end: int,
                       metric: str = "AvgTemp", kind: str = "monthly",
                       broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS,
                       digits: int | None = None) -> DataFrame:
    """Mean of a metric over the stations of a state and an inclusive month range.

    One row ``(metric, value, unit)``; ``value`` is null when nothing matches.
    Plain mean over fact rows (station-months for the monthly kind); rounded
    to ``digits`` places on output when given.
    """
    _known_state(tables, state)
    m0, m1 = params.check_month_range(month_start, month_end)
    fact = tables.fact(kind)
    params.check_metric(fact, kind, metric)
    side = st.in_state(tables.station, state).select("WBAN")
    means = agg.mean_by_station_group(_months(fact, m0, m1), clean.values_of(fact)(metric), side,
                                      broadcast=tables.station_fits(broadcast_rows))
    return means.select(F.lit(metric).alias("metric"), _rounded("value", digits),
                        F.lit(catalog.unit_of(kind, metric)).cast(T.StringType()).alias("unit"))


def station_metric_avg_by_state_month(tables: WeatherTables, month_start: int = 1,
                                      month_end: int = 12, metric: str = "AvgTemp",
                                      kind: str = "monthly",
                                      broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS
                                      ) -> DataFrame:
    """Grouped Q1: ``(State, month, metric, value, unit)`` for every pair with data."""
    m0, m1 = params.check_month_range(month_start, month_end)
    fact = tables.fact(kind)
    params.check_metric(fact, kind, metric)
    side = tables.station.select("WBAN", "State")
    means = agg.mean_by_station_group(_months(fact, m0, m1), clean.values_of(fact)(metric), side,
                                      keys=(MONTH,), attrs=("State",),
                                      broadcast=tables.station_fits(broadcast_rows))
    return means.select("State", MONTH, F.lit(metric).alias("metric"), "value",
                        F.lit(catalog.unit_of(kind, metric)).cast(T.StringType()).alias("unit"))


# ---------------------------------------------------------------- Q2 -------

def monthly_avg_temperature(tables: WeatherTables, month: int | None = None,
                            offset: float = 32.0, metric: str = "AvgTemp",
                            digits: int | None = None) -> DataFrame:
    """National mean of the monthly mean temperature, in °C, per month.

    A plain mean over station-month rows.  ``(month, month_label, avg_c)``;
    with ``month`` given, a single row for that month (null when empty).
    ``offset=31.0`` reproduces the original application's figures; ``digits``
    rounds on output.
    """
    fact = tables.fact("monthly")
    params.check_metric(fact, "monthly", metric)
    celsius = clean.fahrenheit_to_celsius(F.avg(clean.values_of(fact)(metric)), offset).alias("avg_c")
    if month is None:
        out = fact.groupBy(MONTH).agg(celsius)
    else:
        m = params.check_month(month)
        out = _months(fact, m, m).agg(celsius).select(F.lit(m).alias(MONTH), "avg_c")
    return out.select(MONTH, clean.month_label(MONTH).alias("month_label"), _rounded("avg_c", digits))


# ---------------------------------------------------------------- Q3 -------

ANOMALY_COLUMNS = ("YearMonthDay", "WBAN", "Depart", "Max5Speed", "PrecipTotal")


def _month_or_all(df: DataFrame, month: int | None) -> DataFrame:
    if month is None:
        return df
    m = params.check_month(month)
    return _months(df, m, m)


def anomalous_days(tables: WeatherTables, month: int | None, depart_gt: float = 5,
                   wind_gt: float = 20, precip_gt: float = 1,
                   with_month: bool = False) -> DataFrame:
    """Days with a positive departure above ``depart_gt`` and strong wind or rain.

    Comparisons are on DOUBLE values (``5.7 > 5`` and ``1.50 > 1`` hold); a
    missing value makes its comparison unknown, so a day still qualifies
    through the other branch of the disjunction.  ``month=None``: all months;
    ``with_month`` keeps the month of the file that a day came in.
    """
    daily = tables.fact("daily")
    params.require_columns(daily, "daily", ANOMALY_COLUMNS)
    dep, wind, rain = map(clean.values_of(daily), ("Depart", "Max5Speed", "PrecipTotal"))
    return (_month_or_all(daily, month)
            .filter((dep > F.lit(float(depart_gt))) & ((wind > F.lit(float(wind_gt))) | (rain > F.lit(float(precip_gt)))))
            .select("YearMonthDay", "WBAN", dep.alias("Depart"), wind.alias("Max5Speed"),
                    rain.alias("PrecipTotal"), *_kept(daily, with_month)))


def _kept(df: DataFrame, with_month: bool) -> list[str]:
    return [MONTH] if with_month else []


def anomalous_days_formatted(tables: WeatherTables, month: int, **kw) -> DataFrame:
    """Q3 with the date as ``dd/mm/yyyy`` text (column ``date``)."""
    return (anomalous_days(tables, month, **kw)
            .select(clean.ymd_text("YearMonthDay").alias("date"), *ANOMALY_COLUMNS[1:]))


def _count_days(rows: DataFrame, month: int | None) -> DataFrame:
    """``(month, n_days)``: one row for a given month, or one for each of the 12.

    A day belongs to the month of the file that it came in, in both forms.
    """
    if month is None:
        days = rows.select(MONTH, F.lit(1).alias("n"))
        seeds = agg.months_of_year(rows.sparkSession).select(MONTH, F.lit(0).alias("n"))
        return days.unionByName(seeds).groupBy(MONTH).agg(F.sum("n").alias("n_days"))
    return rows.agg(F.count(F.lit(1)).alias("n_days")).select(F.lit(month).alias(MONTH), "n_days")


def anomalous_days_count(tables: WeatherTables, month: int | None, **kw) -> DataFrame:
    """How many anomalous station-days a month has: ``(month, n_days)``;
    ``month=None`` counts every month in one job."""
    m = None if month is None else params.check_month(month)
    return _count_days(anomalous_days(tables, m, with_month=True, **kw), m)


# ---------------------------------------------------------------- Q4 -------

AGRI_COLUMNS = ("WBAN", "YearMonthDay", "Tavg", "DewPoint", "PrecipTotal", "WetBulb")


def agri_days(tables: WeatherTables, month: int | None, wban: int | None = None,
              tavg_range=(60, 75), dew_range=(40, 60),
              null_code_is_clear: bool = False, with_month: bool = False) -> DataFrame:
    """Good farming days: mild mean temperature and dew point, no thunder, no rain.

    A null weather code fails ``NOT LIKE '%TS%'`` (unknown) and drops the day
    unless ``null_code_is_clear``; a blank code passes.  Trace rain (``T``)
    is not a number, so it is not ``== 0`` either.  ``month=None``: all months;
    ``with_month`` keeps the month of the file that a day came in.
    """
    no_storm = ~F.col("CodeSum").like("%TS%")
    if null_code_is_clear:
        no_storm = F.coalesce(no_storm, F.lit(True))
    daily = tables.fact("daily")
    params.require_columns(daily, "daily", AGRI_COLUMNS + ("CodeSum",))
    tavg, dew, rain, wet = map(clean.values_of(daily), ("Tavg", "DewPoint", "PrecipTotal", "WetBulb"))
    days = _month_or_all(daily, month)
    if wban is not None:
        days = days.filter(F.col("WBAN") == F.lit(int(wban)))
    return (days.filter(tavg.between(*map(float, tavg_range)) & dew.between(*map(float, dew_range))
                        & no_storm & (rain == F.lit(0.0)))
            .select("WBAN", "YearMonthDay", tavg.alias("Tavg"), dew.alias("DewPoint"),
                    rain.alias("PrecipTotal"), wet.alias("WetBulb"), *_kept(daily, with_month)))


def agri_days_formatted(tables: WeatherTables, month: int, wban: int | None = None,
                        **kw) -> DataFrame:
    """Q4 as shown to a user: ``dd/mm/yyyy`` date, values rounded to 2 places."""
    rows = agri_days(tables, month, wban, **kw)
    return rows.select("WBAN", clean.ymd_text("YearMonthDay").alias("date"),
                       *[F.round(c, 2).alias(c) for c in AGRI_COLUMNS[2:]])


def agri_days_count(tables: WeatherTables, month: int | None, wban: int | None = None,
                    **kw) -> DataFrame:
    """How many good farming station-days a month has: ``(month, n_days)``;
    ``month=None`` counts every month in one job."""
    m = None if month is None else params.check_month(month)
    return _count_days(agri_days(tables, m, wban, with_month=True, **kw), m)


def agri_days_stations(tables: WeatherTables, month: int, **kw) -> DataFrame:
    """Distinct stations having at least one good farming day: ``(WBAN)``."""
    return agri_days(tables, month, **kw).select("WBAN").distinct()


# ---------------------------------------------------------------- Q5 -------

def station_ids(tables: WeatherTables, state: str) -> DataFrame:
    """Station ids of a state, unordered: ``(WBAN)``."""
    return st.station_ids(tables.station, _known_state(tables, state))


# ---------------------------------------------------------------- Q6 -------

def _hourly_rows(tables, month, metric, wban, include_on_hour):
    """Hourly rows with an ``hour`` bucket; all months when ``month`` is None."""
    hourly = tables.fact("hourly")
    params.check_metric(hourly, "hourly", metric)
    rows = hourly
    if month is not None:
        m = params.check_month(month)
        rows = _months(hourly, m, m)
    if wban is not None:
        rows = rows.filter(F.col("WBAN") == F.lit(int(wban)))
    return (rows.withColumn("hour", clean.hour_bucket("Time", include_on_hour))
            .filter(F.col("hour").isNotNull()))


def hourly_profile(tables: WeatherTables, state: str, month: int,
                   metric: str = "DryBulbFarenheit", wban: int | None = None,
                   include_on_hour: bool = False,
                   broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mean of an hourly metric per hour of day: always 24 rows ``(hour, label, value)``.

    Reading ``t`` (``hhmm``) counts for hour ``i`` when ``i*100 < t < (i+1)*100``,
    so on-the-hour readings are excluded unless ``include_on_hour``.  An hour
    without values reports 0.0.  One scan and one aggregation for all 24 hours.
    """
    _known_state(tables, state)
    rows = _hourly_rows(tables, params.check_month(month), metric, wban, include_on_hour)
    side = st.in_state(tables.station, state).select("WBAN")
    profile = agg.mean_by_station_group(rows, clean.values_of(rows)(metric), side, keys=("hour",),
                                        broadcast=tables.station_fits(broadcast_rows),
                                        all_keys=agg.hours_of_day(rows.sparkSession))
    return agg.finish_profile(profile)


def hourly_profile_by_state(tables: WeatherTables, month: int | None,
                            metric: str = "DryBulbFarenheit", include_on_hour: bool = False,
                            broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Grouped Q6: ``(State, hour, label, value)``, 24 rows for every state of
    the dimension (0.0 where it has no value), as in the single-state form.

    With ``month=None`` the month becomes a key too: ``(State, month, hour,
    label, value)`` for every state, month and hour in one job.
    """
    rows = _hourly_rows(tables, month, metric, None, include_on_hour)
    keys = ("hour",) if month is not None else (MONTH, "hour")
    ranges = {MONTH: (1, 12), "hour": (0, 23)}
    means = agg.mean_by_station_group(rows, clean.values_of(rows)(metric), tables.station.select("WBAN", "State"),
                                      keys=keys, attrs=("State",),
                                      broadcast=tables.station_fits(broadcast_rows),
                                      all_keys=agg.state_keys(tables.station, **{k: ranges[k] for k in keys}))
    return means.select("State", *keys, clean.hour_label("hour").alias("label"),
                        F.coalesce(F.col("value"), F.lit(0.0)).alias("value"))


# ---------------------------------------------------------------- Q7 -------

def _extrema_input(tables, kind, month, metric, broadcast, state=None):
    """Per-station min / max of the month, or per station and month when ``month`` is None.

    With a state and a proven station side, fact rows of other states are
    dropped by a broadcast semi join before aggregating.
    """
    kind = catalog.kind_of(kind)
    fact = tables.fact(kind)
    params.check_metric(fact, kind, metric)
    value = clean.values_of(fact)(metric)
    if state is not None and broadcast:
        fact = st.keep_stations(fact, st.in_state(tables.station, state), broadcast=True)
    if month is None:
        return kind, agg.extrema_partials(fact, value, keys=(MONTH,))
    m = params.check_month(month)
    return kind, agg.extrema_partials(_months(fact, m, m), value)


def metric_extrema(tables: WeatherTables, kind, state: str, month: int, metric: str,
                   broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Stations holding the minimum and the maximum of a metric in a state and month.

    Two rows ``(which, WBAN, Location, Latitude, Longitude, value, difference,
    unit)``, ``which`` in (``min``, ``max``).  Values are compared as DOUBLE
    and rounded only on output; ties go to the lowest WBAN.  ``kind`` is a
    name or type id (1 daily, 2 hourly, 3 monthly); the unit comes from the
    catalog of that kind.
    """
    _known_state(tables, state)
    broadcast = tables.station_fits(broadcast_rows)
    kind, partials = _extrema_input(tables, kind, params.check_month(month), metric, broadcast, state)
    joined = st.attach_station(partials, tables.station, state=state,
                               columns=("State",) + agg.STATION_ATTRS, broadcast=broadcast)
    return (agg.extrema_rows(joined)
            .withColumn("unit", F.lit(catalog.unit_of(kind, metric)).cast(T.StringType())))


def metric_extrema_by_state(tables: WeatherTables, kind, month: int | None, metric: str,
                            broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Grouped Q7: two rows for every state of the dimension, ``(State, which,
    WBAN, ..., unit)``, null ones where it has no value.

    With ``month=None``, two rows per state and each of the 12 months
    (``month`` added).
    """
    broadcast = tables.station_fits(broadcast_rows)
    kind, partials = _extrema_input(tables, kind, month, metric, broadcast)
    joined = st.attach_station(partials, tables.station,
                               columns=("State",) + agg.STATION_ATTRS, broadcast=broadcast)
    keys = ("State",) if month is not None else ("State", MONTH)
    months = {} if month is not None else {MONTH: (1, 12)}
    return (agg.extrema_rows(joined, keys=keys, all_keys=agg.state_keys(tables.station, **months))
            .withColumn("unit", F.lit(catalog.unit_of(kind, metric)).cast(T.StringType())))


# ---------------------------------------------------------------- Q8 -------

def suspect_counts(tables: WeatherTables, month_start: int, month_end: int,
                   state: str | None = None, flag: str = clean.SUSPECT,
                   broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Per station, how many daily values carry ``flag``: ``(WBAN, suspicious_count)``.

    Every text column except the keys is inspected, so the count does not
    depend on how the flag columns are named.  ``state=None`` keeps all
    stations, including ids missing from the station table.  The state test
    is a semi join on the group key: with a proven station side Catalyst
    applies it map-side before aggregating, otherwise after the per-station
    counts, on station-bounded rows.
    """
    m0, m1 = params.check_month_range(month_start, month_end)
    daily = _months(tables.fact("daily"), m0, m1)
    if flag == clean.SUSPECT and SUSPECT_FLAGS in daily.columns:
        per_row = F.col(SUSPECT_FLAGS)           # counted when the clean layer was written
    else:
        per_row = clean.flag_count(clean.text_columns(daily, exclude=key_columns("daily")), flag)
    counts = daily.groupBy("WBAN").agg(F.sum(per_row).cast(T.LongType()).alias("suspicious_count"))
    if state is not None:
        counts = st.keep_stations(counts, st.in_state(tables.station, _known_state(tables, state)),
                                  broadcast=tables.station_fits(broadcast_rows))
    return counts


def unreliable_stations(tables: WeatherTables, month_start: int, month_end: int,
                        state: str | None = None, k: int = 10, flag: str = clean.SUSPECT,
                        broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The ``k`` stations with most suspect values, ties by lowest WBAN.

    Stations with a zero count may appear when fewer than ``k`` have any.
    """
    params.check_positive("k", k)
    counts = suspect_counts(tables, month_start, month_end, state, flag, broadcast_rows)
    return agg.top_k(counts, k, "suspicious_count")


def unreliable_stations_by_state(tables: WeatherTables, month_start: int, month_end: int, k: int = 10,
                                 flag: str = clean.SUSPECT,
                                 broadcast_rows: int | None = st.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Grouped Q8: the ``k`` least reliable stations of every state in one job,
    ``(State, rank, WBAN, suspicious_count)``; ties by lowest WBAN.

    Counts are per station before they meet the dimension, so the ranking
    handles station-level rows, at most ``k`` of a state from each task.
    """
    params.check_positive("k", k)
    counts = suspect_counts(tables, month_start, month_end, None, flag, broadcast_rows)
    placed = st.attach_station(counts, tables.station, columns=("State",), broadcast=tables.station_fits(broadcast_rows))
    return agg.top_k_per_group(placed, ("State",), k, "suspicious_count").select(
        "State", "rank", "WBAN", "suspicious_count")


# ---------------------------------------------------------------- Q9 -------

def metric_catalog(spark: SparkSession, type_id="3") -> DataFrame:
    """Metrics of a record kind: '1' daily, '2' hourly, anything else monthly."""
    return catalog.metric_catalog(spark, catalog.catalog_kind(type_id))
