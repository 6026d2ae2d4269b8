"""Reference SQL (DuckDB dialect) for every registered query instance.

Written independently of the Spark code: it re-derives the weather views
from the driver tables and states each query the plain relational way
(sort + LIMIT or window functions instead of min_by/max_by, IN-subqueries
instead of semi joins).  Column names equal the Spark result's.
"""

from __future__ import annotations

_YMD = "CAST(year({t}) * 10000 + month({t}) * 100 + day({t}) AS INTEGER)"

VIEWS = f"""
station AS (
  SELECT CAST(s_suppkey AS INTEGER) AS WBAN, n_name AS State, s_name AS Location,
         CAST(25 + s_suppkey % 24 AS DOUBLE) AS Latitude,
         CAST(-70 - s_suppkey % 50 AS DOUBLE) AS Longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
daily AS (
  SELECT CAST(l_suppkey AS INTEGER) AS WBAN,
         {_YMD.format(t="l_shipdate")} AS YearMonthDay,
         CASE WHEN l_orderkey % 17 = 0 THEN 'M'
              ELSE CAST(CAST(l_quantity AS INTEGER) + 40 AS VARCHAR) END AS Tavg,
         CASE WHEN l_orderkey % 29 = 0 THEN 's' ELSE ' ' END AS TavgFlag,
         CASE WHEN l_orderkey % 13 = 0 THEN 'M'
              ELSE CAST(CAST(l_quantity AS INTEGER) - 25 AS VARCHAR) END AS Depart,
         CASE WHEN l_partkey % 19 = 0 THEN 'M' ELSE CAST(30 + l_partkey % 45 AS VARCHAR) END AS DewPoint,
         CASE WHEN l_partkey % 31 = 0 THEN 's' ELSE ' ' END AS DewPointFlag,
         CASE WHEN l_partkey % 7 = 0 THEN 'M' ELSE CAST(35 + l_partkey % 40 AS VARCHAR) END AS WetBulb,
         CASE l_linenumber WHEN 1 THEN 'TSRA' WHEN 2 THEN 'RA' WHEN 3 THEN 'BR TS'
              WHEN 4 THEN NULL ELSE ' ' END AS CodeSum,
         CASE CAST(round(l_discount * 100) AS INTEGER)
              WHEN 0 THEN '0.00' WHEN 1 THEN '  T' WHEN 2 THEN 'M' WHEN 3 THEN '0.00'
              WHEN 4 THEN '1.00' WHEN 5 THEN '1.25' WHEN 6 THEN '1.50' WHEN 7 THEN '0.75'
              ELSE '2.50' END AS PrecipTotal,
         CASE WHEN l_partkey % 23 = 0 THEN 'M' ELSE CAST(l_linenumber * 5 AS VARCHAR) END AS Max5Speed,
         CAST(month(l_shipdate) AS INTEGER) AS month
  FROM lineitem
),
hourly AS (
  SELECT CAST(user_id AS INTEGER) AS WBAN,
         CAST(year(ts) * 10000 + m * 100 + CASE WHEN m = month(ts) THEN day(ts) ELSE least(day(ts), 28) END
              AS INTEGER) AS YearMonthDay,
         CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS Time,
         CASE WHEN event_id % 11 = 0 THEN 'M' WHEN event_id % 37 = 0 THEN '  T'
              ELSE CAST(CAST(event_id % 90 AS INTEGER) + 10 AS VARCHAR) END AS DryBulbFarenheit,
         CAST(m AS INTEGER) AS month
  FROM (SELECT *, unnest([month(ts), (event_id // 11) % 11 + 2]) AS m FROM events)
),
monthly AS (
  SELECT CAST(o_custkey % 120 AS INTEGER) AS WBAN,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS YearMonth,
         CASE WHEN o_orderkey % 31 = 0 THEN 'M'
              ELSE CAST(CAST(20 + o_orderkey % 70 AS INTEGER) AS VARCHAR) END AS AvgTemp,
         CAST(month(o_orderdate) AS INTEGER) AS month
  FROM orders
)"""

STATE = "'NATION_3'"
IN_STATE = f"WBAN IN (SELECT WBAN FROM station WHERE State = {STATE})"


def _num(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def _date_text(c: str) -> str:
    return f"strftime(strptime(CAST({c} AS VARCHAR), '%Y%m%d'), '%d/%m/%Y')"


def _sql(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {VIEWS}{extra}\n{body}"


_DAILY_TEXT = ["Tavg", "TavgFlag", "Depart", "DewPoint", "DewPointFlag", "WetBulb",
               "CodeSum", "PrecipTotal", "Max5Speed"]
_SUSPECT = " + ".join(f"(CASE WHEN {c} = 's' THEN 1 ELSE 0 END)" for c in _DAILY_TEXT)

_ANOMALY_WHERE = (f"month = 3 AND {_num('Depart')} > 5 AND "
                  f"({_num('Max5Speed')} > 20 OR {_num('PrecipTotal')} > 1)")
_AGRI_ALL = (f"{_num('Tavg')} BETWEEN 60 AND 75 AND {_num('DewPoint')} BETWEEN 40 AND 60 "
             f"AND NOT (CodeSum LIKE '%TS%') AND {_num('PrecipTotal')} = 0")
_AGRI_WHERE = f"month = 6 AND {_AGRI_ALL}"
_ANOMALY_ALL = f"{_num('Depart')} > 5 AND ({_num('Max5Speed')} > 20 OR {_num('PrecipTotal')} > 1)"
_OFF_HOUR = "Time > 0 AND Time < 2400 AND Time % 100 <> 0"


def _profile(extra_where: str) -> str:
    return _sql(
        "SELECT h.hour, CAST(h.hour AS VARCHAR) || ':00' AS label, "
        "COALESCE(p.value, CAST(0 AS DOUBLE)) AS value FROM hrs h LEFT JOIN prof p USING (hour)",
        "hrs AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24))",
        f"prof AS (SELECT CAST(Time // 100 AS INTEGER) AS hour, AVG({_num('DryBulbFarenheit')}) AS value "
        f"FROM hourly WHERE month = 1 AND {_OFF_HOUR} AND {IN_STATE}{extra_where} GROUP BY 1)")


def _profiles(where: str, month: str) -> str:
    """Every state of the dimension and hour (and month), 0 where there is no value."""
    months = "CROSS JOIN (SELECT CAST(range AS INTEGER) AS month FROM range(1, 13)) " if month else ""
    return _sql(
        f"SELECT State, {month}hour, CAST(hour AS VARCHAR) || ':00' AS label, "
        "COALESCE(value, CAST(0 AS DOUBLE)) AS value FROM wanted LEFT JOIN prof "
        f"USING (State, {month}hour)",
        f"wanted AS (SELECT State, {month}hour FROM (SELECT DISTINCT State FROM station) {months}"
        "CROSS JOIN (SELECT CAST(range AS INTEGER) AS hour FROM range(24)))",
        f"prof AS (SELECT State, {month}CAST(Time // 100 AS INTEGER) AS hour, "
        f"AVG({_num('DryBulbFarenheit')}) AS value FROM hourly JOIN station USING (WBAN) "
        f"{where} {_OFF_HOUR} GROUP BY ALL)")


def _extrema(table: str, metric: str, month: int, unit: str, of=lambda v: v) -> str:
    return _sql(
        f"SELECT 'min' AS which, WBAN, Location, Latitude, Longitude, value, "
        f"(SELECT value FROM mx) - value AS difference, '{unit}' AS unit FROM mn "
        f"UNION ALL "
        f"SELECT 'max' AS which, WBAN, Location, Latitude, Longitude, value, "
        f"value - (SELECT value FROM mn) AS difference, '{unit}' AS unit FROM mx",
        f"per AS (SELECT WBAN, MIN({of(_num(metric))}) AS lo, MAX({of(_num(metric))}) AS hi "
        f"FROM {table} WHERE month = {month} GROUP BY WBAN)",
        f"j AS (SELECT per.*, s.Location, s.Latitude, s.Longitude FROM per JOIN station s USING (WBAN) "
        f"WHERE s.State = {STATE} AND lo IS NOT NULL)",
        "mn AS (SELECT WBAN, Location, Latitude, Longitude, ROUND(lo, 2) AS value FROM j "
        "ORDER BY lo, WBAN LIMIT 1)",
        "mx AS (SELECT WBAN, Location, Latitude, Longitude, ROUND(hi, 2) AS value FROM j "
        "ORDER BY hi DESC, WBAN LIMIT 1)")


def _extrema_by_state(table: str = "daily", metric: str = "Tavg", month: int | None = 3,
                      unit: str = "°F", of=lambda v: v) -> str:
    keys = "State" if month is not None else "State, month"
    where = f"WHERE month = {month} " if month is not None else ""
    per_keys = "WBAN" if month is not None else "WBAN, month"
    out_keys = keys
    months = "" if month is not None else "CROSS JOIN (SELECT CAST(range AS INTEGER) AS month FROM range(1, 13)) "
    side = (f"SELECT {out_keys}, '{{w}}' AS which, {{s}}.WBAN, {{s}}.Location, {{s}}.Latitude, "
            "{s}.Longitude, ROUND({s}.{v}, 2) AS value, ROUND(mx.hi, 2) - ROUND(mn.lo, 2) AS difference, "
            f"'{unit}' AS unit FROM wanted LEFT JOIN mn USING ({keys}) LEFT JOIN mx USING ({keys})")
    return _sql(
        side.format(w="min", s="mn", v="lo") + " UNION ALL " + side.format(w="max", s="mx", v="hi"),
        f"wanted AS (SELECT * FROM (SELECT DISTINCT State FROM station) {months})",
        f"per AS (SELECT {per_keys}, MIN({of(_num(metric))}) AS lo, MAX({of(_num(metric))}) AS hi "
        f"FROM {table} {where}GROUP BY {per_keys})",
        "j AS (SELECT per.*, s.State, s.Location, s.Latitude, s.Longitude "
        "FROM per JOIN station s USING (WBAN) WHERE lo IS NOT NULL)",
        f"mn AS (SELECT * FROM (SELECT j.*, row_number() OVER (PARTITION BY {keys} ORDER BY lo, WBAN) AS rn "
        "FROM j) WHERE rn = 1)",
        f"mx AS (SELECT * FROM (SELECT j.*, row_number() OVER (PARTITION BY {keys} ORDER BY hi DESC, WBAN) "
        "AS rn FROM j) WHERE rn = 1)")


def _unreliable(where: str, k: int = 10) -> str:
    return _sql(f"SELECT WBAN, CAST(SUM({_SUSPECT}) AS BIGINT) AS suspicious_count FROM daily "
                f"WHERE month BETWEEN 1 AND 6{where} GROUP BY WBAN "
                f"ORDER BY suspicious_count DESC, WBAN LIMIT {k}")


def _missing_counts() -> str:
    # fixed values: description and unit of the metrics in the daily view
    metrics = {
        "Tavg": ("Average Temperature", "°F"),
        "Depart": ("Temperature Departure", "°F"),
        "DewPoint": ("Dew Point Temperature", "°F"),
        "WetBulb": ("Wet Bulb Temperature", "°F"),
        "PrecipTotal": ("Total Precipitation", "inches"),
        "Max5Speed": ("Max 5-Minute Wind Speed", "mph"),
    }
    parts = [f"SELECT '{m}' AS metric, CAST(COUNT(*) AS BIGINT) AS n_rows, "
             f"CAST(COUNT(*) FILTER (WHERE trim({m}) = 'M') AS BIGINT) AS n_missing, "
             f"CAST(COUNT(*) FILTER (WHERE trim({m}) = 'T') AS BIGINT) AS n_trace, "
             f"CAST(COUNT({_num(m)}) AS BIGINT) AS n_values, "
             f"'{description}' AS description, '{unit}' AS unit FROM daily"
             for m, (description, unit) in metrics.items()]
    return _sql(" UNION ALL ".join(parts))


def _records_json() -> str:
    fields = ", ".join(f"'{c}': {c}" for c in
                       ["YearMonthDay", "WBAN", "Depart", "Max5Speed", "PrecipTotal"])
    return _sql(f"SELECT CAST(to_json({{{fields}}}) AS VARCHAR) AS record FROM ("
                f"SELECT YearMonthDay, WBAN, {_num('Depart')} AS Depart, {_num('Max5Speed')} AS Max5Speed, "
                f"{_num('PrecipTotal')} AS PrecipTotal FROM daily WHERE {_ANOMALY_WHERE})")


def _linear(a: float, b: float):
    return lambda v: f"({v} * CAST('{a!r}' AS DOUBLE) + CAST('{b!r}' AS DOUBLE))"


_CELSIUS = _linear(5 / 9, 459.67 * (5 / 9) - 273.15)
_KMH = _linear((1609.344 / 3600) / (1000 / 3600), 0.0)

_VERSIONS = """versions AS (
  SELECT WBAN, CAST(v.month AS INTEGER) AS month, n_name AS State, v.Location FROM (
    SELECT CAST(s_suppkey AS INTEGER) AS WBAN, unnest(
      [{'month': CASE WHEN s_suppkey % 5 = 1 THEN 3 ELSE 1 END, 'n': s_nationkey, 'Location': s_name}] ||
      CASE WHEN s_suppkey % 4 = 0 THEN
        [{'month': s_suppkey % 9 + 4, 'n': (s_nationkey + 1) % 25, 'Location': s_name || ' moved'}] ELSE [] END) AS v
    FROM supplier) JOIN nation ON v.n = n_nationkey)"""


def _valid(table: str) -> str:
    """Each row of a fact with the version of its station that is valid in its month."""
    return f"{table} f ASOF JOIN versions v ON f.WBAN = v.WBAN AND f.month >= v.month"


ORACLE = {
    "station_metric_avg": _sql(
        f"SELECT 'AvgTemp' AS metric, AVG({_num('AvgTemp')}) AS value, '°F' AS unit "
        f"FROM monthly WHERE month BETWEEN 2 AND 5 AND {IN_STATE}"),
    "station_metric_avg_rounded": _sql(
        f"SELECT 'Tavg' AS metric, ROUND(AVG({_num('Tavg')}), 2) AS value, '°F' AS unit "
        f"FROM daily WHERE {IN_STATE}"),
    "station_metric_avg_by_state_month": _sql(
        f"SELECT s.State, m.month, 'AvgTemp' AS metric, AVG({_num('m.AvgTemp')}) AS value, "
        f"'°F' AS unit FROM monthly m JOIN station s USING (WBAN) GROUP BY s.State, m.month"),
    "monthly_avg_temp_c": _sql(
        f"SELECT month, lpad(CAST(month AS VARCHAR), 2, '0') AS month_label, "
        f"(AVG({_num('AvgTemp')}) - CAST(32 AS DOUBLE)) / CAST(1.8 AS DOUBLE) AS avg_c "
        f"FROM monthly GROUP BY month"),
    "monthly_avg_temp_c_offset31": _sql(
        f"SELECT month, lpad(CAST(month AS VARCHAR), 2, '0') AS month_label, "
        f"(AVG({_num('AvgTemp')}) - CAST(31 AS DOUBLE)) / CAST(1.8 AS DOUBLE) AS avg_c "
        f"FROM monthly GROUP BY month"),
    "anomalous_days": _sql(
        f"SELECT YearMonthDay, WBAN, {_num('Depart')} AS Depart, {_num('Max5Speed')} AS Max5Speed, "
        f"{_num('PrecipTotal')} AS PrecipTotal FROM daily WHERE {_ANOMALY_WHERE}"),
    "anomalous_days_formatted": _sql(
        f"SELECT {_date_text('YearMonthDay')} AS date, WBAN, {_num('Depart')} AS Depart, "
        f"{_num('Max5Speed')} AS Max5Speed, {_num('PrecipTotal')} AS PrecipTotal "
        f"FROM daily WHERE {_ANOMALY_WHERE}"),
    "anomalous_days_count": _sql(
        f"SELECT CAST(3 AS INTEGER) AS month, COUNT(*) AS n_days FROM daily WHERE {_ANOMALY_WHERE}"),
    "agri_days": _sql(
        f"SELECT WBAN, YearMonthDay, {_num('Tavg')} AS Tavg, {_num('DewPoint')} AS DewPoint, "
        f"{_num('PrecipTotal')} AS PrecipTotal, {_num('WetBulb')} AS WetBulb FROM daily WHERE {_AGRI_WHERE}"),
    "agri_days_formatted": _sql(
        f"SELECT WBAN, {_date_text('YearMonthDay')} AS date, ROUND({_num('Tavg')}, 2) AS Tavg, "
        f"ROUND({_num('DewPoint')}, 2) AS DewPoint, ROUND({_num('PrecipTotal')}, 2) AS PrecipTotal, "
        f"ROUND({_num('WetBulb')}, 2) AS WetBulb FROM daily WHERE {_AGRI_WHERE}"),
    "agri_days_station": _sql(
        f"SELECT WBAN, YearMonthDay, {_num('Tavg')} AS Tavg, {_num('DewPoint')} AS DewPoint, "
        f"{_num('PrecipTotal')} AS PrecipTotal, {_num('WetBulb')} AS WetBulb FROM daily "
        f"WHERE {_AGRI_WHERE} AND WBAN = 1"),
    "agri_days_stations": _sql(f"SELECT DISTINCT WBAN FROM daily WHERE {_AGRI_WHERE}"),
    "anomalous_days_count_by_month": _sql(
        f"SELECT CAST(m.range AS INTEGER) AS month, COUNT(d.WBAN) AS n_days FROM range(1, 13) m "
        f"LEFT JOIN (SELECT * FROM daily WHERE {_ANOMALY_ALL}) d ON d.month = m.range GROUP BY m.range"),
    "agri_days_count_by_month": _sql(
        f"SELECT CAST(m.range AS INTEGER) AS month, COUNT(d.WBAN) AS n_days FROM range(1, 13) m "
        f"LEFT JOIN (SELECT * FROM daily WHERE {_AGRI_ALL}) d ON d.month = m.range GROUP BY m.range"),
    "agri_days_count": _sql(
        f"SELECT CAST(6 AS INTEGER) AS month, COUNT(*) AS n_days FROM daily WHERE {_AGRI_WHERE}"),
    "station_ids": _sql(f"SELECT DISTINCT WBAN FROM station WHERE State = {STATE}"),
    "hourly_profile": _profile(""),
    "hourly_profile_station": _profile(" AND WBAN = 68"),
    "hourly_profile_by_state": _profiles("WHERE month = 1 AND", ""),
    "hourly_profile_by_state_month": _profiles("WHERE", "month, "),
    "metric_extrema_daily": _extrema("daily", "Tavg", 3, "°F"),
    "metric_extrema_hourly": _extrema("hourly", "DryBulbFarenheit", 1, "°F"),
    "metric_extrema_monthly": _extrema("monthly", "AvgTemp", 3, "°F"),
    "metric_extrema_by_state": _extrema_by_state(),
    "metric_extrema_by_state_month": _extrema_by_state("monthly", "AvgTemp", None),
    "unreliable_top10_all": _unreliable(""),
    "unreliable_top10_state": _unreliable(f" AND {IN_STATE}"),
    "unreliable_top2_state": _unreliable(f" AND {IN_STATE}", 2),
    # building blocks
    "scan_csv_comma": _sql("SELECT * FROM daily"),
    "scan_csv_pipe": _sql("SELECT * FROM station"),
    "scan_month_range": _sql("SELECT * FROM daily WHERE month BETWEEN 2 AND 4"),
    "scan_month_files": _sql("SELECT * FROM daily WHERE month BETWEEN 2 AND 4"),
    "union_months": _sql("SELECT * FROM daily"),
    "join_station_left_state": _sql(
        f"SELECT * FROM monthly JOIN station USING (WBAN) WHERE State = {STATE}"),
    "join_station_semi": _sql(f"SELECT * FROM daily WHERE {IN_STATE}"),
    "flag_count_per_row": _sql(
        f"SELECT WBAN, YearMonthDay, month, {_SUSPECT} AS suspect_flags FROM daily"),
    "missing_count_by_metric": _missing_counts(),
    "metric_range": _sql(
        f"SELECT WBAN, MIN({_num('Tavg')}) AS min_value, MAX({_num('Tavg')}) AS max_value, "
        f"MAX({_num('Tavg')}) - MIN({_num('Tavg')}) AS value_range FROM daily GROUP BY WBAN"),
    "records_json": _records_json(),
    # derived layers
    "join_station_asof": _sql(f"SELECT f.*, v.State, v.Location FROM {_valid('monthly')}", _VERSIONS),
    "asof_metric_avg_by_state_month": _sql(
        f"SELECT v.State, f.month, 'AvgTemp' AS metric, AVG({_num('f.AvgTemp')}) AS value, '°F' AS unit "
        f"FROM {_valid('monthly')} GROUP BY v.State, f.month", _VERSIONS),
    "moved_stations": _sql(
        "SELECT WBAN, month, before, State FROM (SELECT *, lag(State) OVER (PARTITION BY WBAN ORDER BY month) AS before "
        "FROM versions) WHERE before IS NOT NULL AND before <> State", _VERSIONS),
    "clustered_station_rows": _sql("SELECT * FROM daily WHERE WBAN = 68"),
    "scan_header_groups": _sql("SELECT * FROM monthly"),
    "checked_lines": _sql(
        "SELECT CASE WHEN WBAN % 23 = 5 THEN 'wrong number of values' WHEN WBAN % 17 = 3 THEN 'WBAN is no number' "
        "WHEN WBAN % 19 = 4 THEN 'WBAN is missing' ELSE 'accepted' END AS reason, COUNT(*) AS n_lines "
        "FROM monthly GROUP BY 1"),
    "distinct_readings": _sql(
        "SELECT WBAN, YearMonthDay, Time, MIN(DryBulbFarenheit) AS DryBulbFarenheit, month FROM hourly "
        "GROUP BY WBAN, YearMonthDay, Time, month"),
    "duplicate_readings": _sql(
        "SELECT WBAN, YearMonthDay, Time, COUNT(*) AS n FROM hourly GROUP BY WBAN, YearMonthDay, Time HAVING COUNT(*) > 1"),
    "unreliable_top3_by_state": _sql(
        "SELECT State, CAST(row_number() OVER own AS INTEGER) AS rank, WBAN, suspicious_count FROM ("
        f"SELECT WBAN, CAST(SUM({_SUSPECT}) AS BIGINT) AS suspicious_count FROM daily WHERE month BETWEEN 1 AND 6 "
        "GROUP BY WBAN) JOIN station USING (WBAN) "
        "WINDOW own AS (PARTITION BY State ORDER BY suspicious_count DESC, WBAN) QUALIFY row_number() OVER own <= 3"),
    "station_metric_avg_celsius": _sql(
        f"SELECT 'AvgTemp' AS metric, {_CELSIUS('AVG(' + _num('AvgTemp') + ')')} AS value, '°C' AS unit "
        f"FROM monthly WHERE month BETWEEN 2 AND 5 AND {IN_STATE}"),
    "metric_extrema_daily_celsius": _extrema("daily", "Tavg", 3, "°C", _CELSIUS),
    "metric_extrema_by_state_kmh": _extrema_by_state("daily", "Max5Speed", 3, "km/h", _KMH),
}

# Maintained partials give the rows of the same question over the facts.
_MAINTAINED = ("metric_avg", "metric_avg_by_state_month", "monthly_avg_temp_c", "hourly_profile",
               "hourly_profile_by_state_month", "metric_extrema_daily", "metric_extrema_by_state_month",
               "unreliable_top10_state")
ORACLE |= {f"maintained_{n}": ORACLE[n if n in ORACLE else f"station_{n}"] for n in _MAINTAINED}
