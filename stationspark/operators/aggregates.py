"""Aggregation operators over facts and the station dimension.

Every fact-level aggregation is planned by Spark as a partial aggregate
before the shuffle and a final one after it, so a station holding a third of
all rows still ships one partial row per map task.

Station attributes (state, location) enter in one of two ways, with the
same result:

* the station side is proven small: it is broadcast, joined map-side, and
  fact rows aggregate straight by the output keys;
* otherwise facts are first reduced per station (``*_partials``: at most one
  row per station and key), and only those rows meet the station side in a
  shuffle join before the partials are combined.

Extrema always go through per-station min / max (fixed-width hash
aggregation); ``min_by`` / ``max_by`` with station attributes then run over
station-level rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.functions.clean import hour_label
from stationspark.operators import stations as st

STATION_ATTRS = ("Location", "Latitude", "Longitude")


def mean_by_station_group(fact: DataFrame, value: Column, side: DataFrame, keys=(),
                          attrs=(), broadcast: bool = False,
                          all_keys: DataFrame | None = None) -> DataFrame:
    """Mean of ``value`` per ``(*attrs, *keys)`` over fact rows whose station is in ``side``.

    ``side`` is ``(WBAN, *attrs)`` with one row per WBAN (a state's stations,
    or all of them with ``State`` as attribute).  Two plans, same result:

    * ``broadcast`` (the side's size is proven): join map-side and aggregate
      fact rows straight by the output keys; each task ships one partial row
      per output group.  Attributes travel as an integer group code
      (:func:`stations.group_codes`) and are named after the aggregation.
    * otherwise: reduce facts to per-station partials first, join those
      (bounded by stations x keys) by shuffle, then combine.

    ``all_keys`` lists ``(*attrs, *keys)`` rows that must appear in the
    output even without data; they enter the same aggregation as rows without
    a value, so no extra join is needed.  Their value is null.
    """
    how = "inner" if attrs else "left_semi"
    if broadcast and attrs:
        # Group fact rows on an integer code of the attributes, then name them.
        per_station, per_group = st.group_codes(side, attrs)
        rows = fact.join(F.broadcast(per_station), "WBAN").select(
            "_code", *keys, value.cast(T.DoubleType()).alias("_v"))
        if all_keys is not None:
            same = [all_keys[a].eqNullSafe(per_group[a]) for a in attrs]
            rows = rows.unionByName(all_keys.join(per_group, same).select(
                "_code", *keys, F.lit(None).cast(T.DoubleType()).alias("_v")))
        means = rows.groupBy("_code", *keys).agg(F.avg("_v").alias("value"))
        return means.join(F.broadcast(per_group), "_code").select(*attrs, *keys, "value")
    if broadcast:
        rows = fact.join(F.broadcast(side), "WBAN", how).select(
            *keys, value.cast(T.DoubleType()).alias("_v"))
        if all_keys is not None:
            rows = rows.unionByName(all_keys.select(*keys, F.lit(None).cast(T.DoubleType()).alias("_v")))
        return rows.groupBy(*keys).agg(F.avg("_v").alias("value"))
    joined = mean_partials(fact, value, keys).join(side, "WBAN", how).drop("WBAN")
    if all_keys is not None:
        joined = joined.unionByName(all_keys.select(
            *attrs, *keys, F.lit(None).cast(T.DoubleType()).alias("v_sum"),
            F.lit(0).cast(T.LongType()).alias("v_n")))
    return mean_of_partials(joined, keys=(*attrs, *keys))


def mean_partials(fact: DataFrame, value: Column, keys=()) -> DataFrame:
    """``(WBAN, *keys, v_sum, v_n)``: sum and count of non-null values."""
    return fact.groupBy("WBAN", *keys).agg(F.sum(value).alias("v_sum"),
                                           F.count(value).alias("v_n"))


def mean_of_partials(partials: DataFrame, keys=(), alias: str = "value") -> DataFrame:
    """Mean over all rows behind the partials; null when no value is present."""
    mean = F.try_divide(F.sum("v_sum"), F.sum("v_n").cast(T.DoubleType()))
    return partials.groupBy(*keys).agg(mean.alias(alias))


def extrema_partials(fact: DataFrame, value: Column, keys=()) -> DataFrame:
    """``(WBAN, *keys, v_min, v_max)`` per station."""
    return fact.groupBy("WBAN", *keys).agg(F.min(value).alias("v_min"),
                                           F.max(value).alias("v_max"))


def extrema_rows(partials_with_attrs: DataFrame, keys=(), attrs=STATION_ATTRS,
                 digits: int = 2, all_keys: DataFrame | None = None) -> DataFrame:
    """Two rows per group: the station with the lowest and with the highest value.

    Ties go to the lowest WBAN.  ``value`` is rounded to ``digits``;
    ``difference`` is the rounded maximum minus the rounded minimum.  A group
    without any value still yields its two rows, with nulls; ``all_keys``
    lists the groups that must appear, also without a row.
    """
    rows = partials_with_attrs
    if all_keys is not None:
        rows = rows.unionByName(all_keys, allowMissingColumns=True)
    row = F.struct("WBAN", *attrs)
    wban_desc = (-F.col("WBAN").cast(T.LongType())).alias("neg_wban")
    valued = F.col("v_min").isNotNull()      # a null order is passed over
    agg = rows.groupBy(*keys).agg(
        F.min_by(row, F.when(valued, F.struct("v_min", "WBAN"))).alias("lo_row"),
        F.min("v_min").alias("lo"),
        F.max_by(row, F.when(valued, F.struct(F.col("v_max"), wban_desc))).alias("hi_row"),
        F.max("v_max").alias("hi"),
    )
    lo, hi = F.round("lo", digits), F.round("hi", digits)

    def side(which: str, r: str, v: Column) -> Column:
        return F.struct(F.lit(which).alias("which"),
                        *[F.col(f"{r}.{c}").alias(c) for c in ("WBAN", *attrs)],
                        v.alias("value"))

    return agg.select(*keys, F.inline(F.array(side("min", "lo_row", lo), side("max", "hi_row", hi))),
                      (hi - lo).alias("difference"))


def top_k(df: DataFrame, k: int, by: str, tie_break: str = "WBAN") -> DataFrame:
    """``k`` rows with the largest ``by``; ties by ascending ``tie_break``.

    Planned as ``TakeOrderedAndProject``: each task keeps its own top ``k``.
    """
    return df.orderBy(F.col(by).desc(), F.col(tie_break).asc()).limit(k)


def top_k_per_group(df: DataFrame, groups, k: int, by: str, tie_break: str = "WBAN") -> DataFrame:
    """The ``k`` rows with the largest ``by`` in every group, with their ``rank``.

    The rank's filter lets Spark keep at most ``k`` rows of a group in each
    task before the shuffle (``WindowGroupLimit``), so a group that holds most
    of the rows still sends k rows a task.
    """
    order = Window.partitionBy(*groups).orderBy(F.col(by).desc(), F.col(tie_break).asc())
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hours_of_day(spark: SparkSession) -> DataFrame:
    """The 24 hours ``(hour INT)``: key rows for a complete hour profile (one partition)."""
    return spark.range(0, 24, 1, 1).select(F.col("id").cast(T.IntegerType()).alias("hour"))


def months_of_year(spark: SparkSession) -> DataFrame:
    """The 12 months ``(month INT)``: key rows for complete results (one partition)."""
    return spark.range(1, 13, 1, 1).select(F.col("id").cast(T.IntegerType()).alias("month"))


def state_keys(station: DataFrame, **ranges) -> DataFrame:
    """``(State, *ranges)`` for every state of the dimension and every value of
    each inclusive range.

    Built by generators over the distinct states (at most one row per state
    enters them), not by a join.
    """
    rows = station.select("State").distinct()
    for name, (low, high) in ranges.items():
        values = F.sequence(F.lit(low), F.lit(high)).cast("array<int>")
        rows = rows.select(*rows.columns, F.explode(values).alias(name))
    return rows


def finish_profile(profile: DataFrame, value: str = "value", fill: float = 0.0) -> DataFrame:
    """Label the hours, fill hours without a value, order by hour."""
    return (profile.select("hour", hour_label("hour").alias("label"),
                           F.coalesce(F.col(value), F.lit(float(fill))).alias(value))
            .orderBy("hour"))
