"""Building-block queries: single operators shown on their own.

They cover inventory rows that the composite queries only use inside a
larger plan: the readers and writers, the two station joins, the month
union, the per-row flag count, the missing-marker report, the value range
and JSON records.  Readers are exercised on files that Spark first writes
from the driver tables into the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationspark.functions import clean, params
from stationspark.operators import stations as st
from stationspark.plans import queries as q
from stationspark.session import scratch_path
from stationspark.sources import catalog, fixtures, readers, schemas, sinks
from stationspark.sources.schemas import key_columns
from stationspark.sources.tables import WeatherTables

STATE = "NATION_3"
DAILY_BY_MONTH = schemas.by_month(schemas.DAILY)

# Files written per (application, sf_dir, kind, format) and reused in-process.
_written: dict[tuple, str] = {}


def _materialized(spark: SparkSession, sf_dir: str, kind: str, fmt: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind, fmt)
    if key not in _written:
        df = getattr(fixtures.load(spark, sf_dir), kind)
        root = scratch_path(spark, f"layout-{fmt}")
        if fmt == "parquet":
            sinks.write_parquet(df, f"{root}/{kind}")
        elif fmt == "month-files":
            sinks.write_month_files(df, root, kind)
        else:
            sinks.write_delimited(df, f"{root}/{kind}", kind)
        _written[key] = root
    return _written[key]


# ------------------------------------------------------------ operators ----

def flag_count_per_row(daily: DataFrame, flag: str = clean.SUSPECT) -> DataFrame:
    """Every daily row with the number of its text values equal to ``flag``."""
    columns = clean.text_columns(daily, exclude=key_columns("daily"))
    return daily.select("WBAN", "YearMonthDay", "month",
                        clean.flag_count(columns, flag).alias("suspect_flags"))


def missing_count_by_metric(tables: WeatherTables, kind: str = "daily") -> DataFrame:
    """Per catalog metric present in the table: rows, ``M`` markers, ``T`` markers
    and values that parse as numbers, with description and unit.

    One pass: a single aggregate row holds all counters, which is then turned
    into one row per metric; the 57-row catalog joins by broadcast.
    """
    kind = catalog.kind_of(kind)
    fact = tables.fact(kind)
    metrics = [m for m in catalog.METRICS[kind] if m in fact.columns]
    counters, value = [], clean.values_of(fact)
    # one trimmed text serves a metric's three counters
    texts = set(clean.text_columns(fact))
    fact = fact.select(*[F.trim(m).alias(m) if m in texts else F.col(m) for m in metrics])
    for m in metrics:
        text = F.col(m).cast("string")
        counters += [F.count_if(text == clean.MISSING).alias(f"{m}__m"),
                     F.count_if(text == clean.TRACE).alias(f"{m}__t"),
                     F.count(value(m)).alias(f"{m}__v")]
    totals = fact.agg(F.count(F.lit(1)).alias("n_rows"), *counters)
    per_metric = F.array(*[F.struct(F.lit(m).alias("metric"),
                                    F.col(f"{m}__m").alias("n_missing"),
                                    F.col(f"{m}__t").alias("n_trace"),
                                    F.col(f"{m}__v").alias("n_values")) for m in metrics])
    rows = totals.select("n_rows", F.inline(per_metric))
    units = F.broadcast(catalog.metric_catalog(fact.sparkSession, kind)
                        .select("metric", "description", "unit"))
    return rows.join(units, "metric", "left")


def metric_range(tables: WeatherTables, kind: str, metric: str, month_start: int = 1,
                 month_end: int = 12) -> DataFrame:
    """Per station: lowest and highest value of a metric and their difference."""
    kind = catalog.kind_of(kind)
    m0, m1 = params.check_month_range(month_start, month_end)
    fact = tables.fact(kind)
    params.check_metric(fact, kind, metric)
    v = clean.values_of(fact)(metric)
    return (fact.filter(F.col("month").between(m0, m1)).groupBy("WBAN")
            .agg(F.min(v).alias("min_value"), F.max(v).alias("max_value"))
            .withColumn("value_range", F.col("max_value") - F.col("min_value")))


# ------------------------------------------------------------ registry -----

def _scan_csv_comma(spark, sf_dir):
    root = _materialized(spark, sf_dir, "daily", "csv")
    return readers.read_partitioned(spark, root, "daily", fmt="csv")


def _scan_csv_pipe(spark, sf_dir):
    root = _materialized(spark, sf_dir, "station", "csv")
    return readers.read_partitioned(spark, root, "station", fmt="csv")


def _scan_month_range(spark, sf_dir):
    root = _materialized(spark, sf_dir, "daily", "parquet")
    daily = readers.read_partitioned(spark, root, "daily", schema=DAILY_BY_MONTH)
    return daily.filter(F.col("month").between(2, 4))


def _scan_month_files(spark, sf_dir):
    root = _materialized(spark, sf_dir, "daily", "month-files")
    return readers.read_month_files(spark, root, "daily", months=[2, 3, 4])


def _union_months(spark, sf_dir):
    root = _materialized(spark, sf_dir, "daily", "parquet")
    return readers.union_months([readers.read_month(spark, root, "daily", m, schema=schemas.DAILY)
                                 for m in range(1, 13)])


def _tables(fn: Callable[[WeatherTables], DataFrame]):
    return lambda spark, sf_dir: fn(fixtures.load(spark, sf_dir))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_csv_comma": _scan_csv_comma,
        "scan_csv_pipe": _scan_csv_pipe,
        "scan_month_range": _scan_month_range,
        "scan_month_files": _scan_month_files,
        "union_months": _union_months,
        "join_station_left_state": _tables(
            lambda t: st.attach_station(t.monthly, t.station, state=STATE,
                                        broadcast=t.station_fits(st.DEFAULT_BROADCAST_ROWS))),
        "join_station_semi": _tables(
            lambda t: st.keep_stations(t.daily, st.in_state(t.station, STATE),
                                       broadcast=t.station_fits(st.DEFAULT_BROADCAST_ROWS))),
        "flag_count_per_row": _tables(lambda t: flag_count_per_row(t.daily)),
        "missing_count_by_metric": _tables(lambda t: missing_count_by_metric(t, "daily")),
        "metric_range": _tables(lambda t: metric_range(t, "daily", "Tavg")),
        "records_json": _tables(lambda t: sinks.records_json(q.anomalous_days(t, 3))),
    }


__all__ = ["flag_count_per_row", "missing_count_by_metric", "metric_range", "registered"]
