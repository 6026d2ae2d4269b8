"""Q1 and Q7 in a unit of the caller's choice.

The unit must measure what the metric's own unit measures (``ValueError``
otherwise, before anything runs).  A mean is converted after it is taken, an
extremum before it is rounded; a difference of two values by scale alone.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationspark.functions import clean, units
from stationspark.plans import queries as q
from stationspark.sources import catalog
from stationspark.sources.tables import WeatherTables


def station_metric_avg(tables: WeatherTables, state: str, month_start: int, month_end: int, metric: str, unit: str,
                       kind: str = "monthly", digits: int | None = None, **options) -> DataFrame:
    """Q1 in ``unit``: ``(metric, value, unit)``."""
    return _mean(q.station_metric_avg(tables, state, month_start, month_end, metric, kind, **options),
                 kind, metric, unit, digits)


def station_metric_avg_by_state_month(tables: WeatherTables, metric: str, unit: str, kind: str = "monthly",
                                      month_start: int = 1, month_end: int = 12, digits: int | None = None,
                                      **options) -> DataFrame:
    """Grouped Q1 in ``unit``."""
    return _mean(q.station_metric_avg_by_state_month(tables, month_start, month_end, metric, kind, **options),
                 kind, metric, unit, digits)


def _mean(means: DataFrame, kind: str, metric: str, unit: str, digits: int | None) -> DataFrame:
    value = units.convert(F.col("value"), units.unit_of(kind, metric), units.target_unit(kind, metric, unit))
    return means.withColumns({"value": value if digits is None else F.round(value, digits), "unit": F.lit(unit)})


def in_unit(tables: WeatherTables, kind: str, metric: str, unit: str) -> WeatherTables:
    """The tables with one metric of a kind as DOUBLE in ``unit``."""
    fact = tables.fact(kind)
    value = units.convert(clean.values_of(fact)(metric), units.unit_of(kind, metric),
                          units.target_unit(kind, metric, unit))
    out = replace(tables, **{kind: fact.withColumn(metric, value)})
    out._fits.update(tables._fits)      # the dimension is the same
    out._states.update(tables._states)
    return out


def metric_extrema(tables: WeatherTables, kind, state: str, month: int, metric: str, unit: str, **options) -> DataFrame:
    """Q7 in ``unit``."""
    kind = catalog.kind_of(kind)
    q.params.check_metric(tables.fact(kind), kind, metric)
    return q.metric_extrema(in_unit(tables, kind, metric, unit), kind, state, month, metric,
                            **options).withColumn("unit", F.lit(unit))


def metric_extrema_by_state(tables: WeatherTables, kind, month: int | None, metric: str, unit: str, **options) -> DataFrame:
    """Grouped Q7 in ``unit``."""
    kind = catalog.kind_of(kind)
    q.params.check_metric(tables.fact(kind), kind, metric)
    return q.metric_extrema_by_state(in_unit(tables, kind, metric, unit), kind, month, metric,
                                     **options).withColumn("unit", F.lit(unit))
