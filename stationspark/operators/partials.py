"""Mergeable partial aggregates of the facts: kept once, asked often.

One row for each station, month, hour and metric: sum, count, least and
greatest value.  Any mean, profile, extremum or flag count of the public
queries follows from them by merging (sums add, extrema compare), so a table
of stations x months x hours x metrics stands in for the fact scan.

``hour`` is the hour of the reading's clock time and ``on_hour`` whether it
was taken exactly on it (both null for kinds without a time, and where the
time is none of a day's).  The suspect flags of a daily row count as a metric
of their own, ``SUSPECT_FLAGS``.  A group without a single value keeps its row
(count 0), for the queries over facts give a null mean there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.functions import clean
from stationspark.sources.catalog import METRICS
from stationspark.sources.schemas import PARTITION_COLUMN, SUSPECT_FLAGS, YEAR_COLUMN, key_columns

KINDS = ("daily", "hourly", "monthly")
MERGED = ("v_sum", "v_n", "v_min", "v_max")

PARTIALS = T.StructType([
    T.StructField("WBAN", T.IntegerType()), T.StructField("hour", T.IntegerType()),
    T.StructField("on_hour", T.BooleanType()), T.StructField("metric", T.StringType()),
    T.StructField("v_sum", T.DoubleType()), T.StructField("v_n", T.LongType()),
    T.StructField("v_min", T.DoubleType()), T.StructField("v_max", T.DoubleType()),
    T.StructField(YEAR_COLUMN, T.IntegerType()), T.StructField(PARTITION_COLUMN, T.IntegerType())])


def _clock(fact: DataFrame) -> tuple[Column, Column]:
    if "Time" not in fact.columns:
        return F.lit(None).cast("int"), F.lit(None).cast("boolean")
    hour = clean.hour_bucket("Time", include_on_hour=True)
    return hour, F.when(hour.isNotNull(), F.col("Time") % 100 == 0)


def _values(fact: DataFrame, kind: str) -> dict[str, Column]:
    value = clean.values_of(fact)
    out = {m: value(m) for m in METRICS[kind] if m in fact.columns}
    if kind == "daily":
        flags = F.col(SUSPECT_FLAGS) if SUSPECT_FLAGS in fact.columns else \
            clean.flag_count(clean.text_columns(fact, exclude=key_columns(kind)))
        out[SUSPECT_FLAGS] = flags.cast("double")
    return out


def build(fact: DataFrame, kind: str, year: int | None = None) -> DataFrame:
    """Partials of a fact table, with its ``year`` column or the given year.

    One aggregation by station, month and hour with all metrics side by side,
    turned into a row for each metric afterwards: facts are not multiplied,
    and each task ships one row for each group.
    """
    if kind not in KINDS:
        raise ValueError(f"no partials of kind {kind!r}; expected one of {KINDS}")
    values = _values(fact, kind)
    hour, on_hour = _clock(fact)
    of_year = F.col(YEAR_COLUMN) if YEAR_COLUMN in fact.columns else F.lit(year).cast("int")
    keys = [of_year.alias(YEAR_COLUMN), F.col(PARTITION_COLUMN), F.col("WBAN"), hour.alias("hour"), on_hour.alias("on_hour")]
    names = list(values)
    rows = fact.select(*keys, *[values[m].alias(f"m{i}") for i, m in enumerate(names)])
    aggregates = [f(f"m{i}").alias(f"{a}{i}") for i in range(len(names))
                  for a, f in (("s", F.sum), ("n", F.count), ("l", F.min), ("h", F.max))]
    grouped = rows.groupBy(YEAR_COLUMN, PARTITION_COLUMN, "WBAN", "hour", "on_hour").agg(*aggregates)
    per_metric = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"s{i}").alias("v_sum"), F.col(f"n{i}").alias("v_n"),
                 F.col(f"l{i}").alias("v_min"), F.col(f"h{i}").alias("v_max")) for i, m in enumerate(names)])
    out = grouped.select("WBAN", "hour", "on_hour", F.inline(per_metric), YEAR_COLUMN, PARTITION_COLUMN)
    return out.select(*PARTIALS.fieldNames())


def merge(partials: DataFrame, keys) -> DataFrame:
    """Partials of coarser keys."""
    return partials.groupBy(*keys).agg(F.sum("v_sum").alias("v_sum"), F.sum("v_n").alias("v_n"),
                                       F.min("v_min").alias("v_min"), F.max("v_max").alias("v_max"))
