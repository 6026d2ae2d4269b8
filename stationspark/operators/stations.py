"""Station dimension operators: membership by state, attribute joins, dedup, group codes.

Broadcast policy: a station side is broadcast only after ``row_count_at_most``
has proven a row bound (one count), normally once per loaded dimension
through :meth:`WeatherTables.station_fits`.  Without that
proof the join is planned by shuffle, and aggregating queries first reduce the
facts to per-station partials (see :mod:`stationspark.operators.aggregates`)
so the shuffled join input is bounded by the number of stations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Largest station side we broadcast: 5 narrow columns, well below 100 MB.
DEFAULT_BROADCAST_ROWS = 250_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows: one count, of which
    every task sends a single row."""
    return df.count() <= max_rows


def _side(df: DataFrame, broadcast: bool) -> DataFrame:
    return F.broadcast(df) if broadcast else df


def in_state(station: DataFrame, state: str | None) -> DataFrame:
    """Station rows of one state (all rows when ``state`` is None)."""
    return station if state is None else station.filter(F.col("State") == F.lit(state))


def station_ids(station: DataFrame, state: str | None) -> DataFrame:
    """Distinct station ids of a state: ``(WBAN INT)``."""
    return in_state(station, state).select("WBAN").distinct()


def latest_station_rows(station: DataFrame, order=("year", "month")) -> DataFrame:
    """One row per WBAN: the row of the latest file, by the columns of ``order``
    that are there.  Of several rows in one file the greatest by its attributes
    stays, so every load gives the same row.

    The result is the dimension the queries expect: unique WBAN, so joins
    never fan out.
    """
    order = [c for c in order if c in station.columns]
    attrs = [c for c in station.columns if c != "WBAN" and c not in order]
    latest = F.max(F.struct(*order, *attrs)).alias("_row")
    return station.groupBy("WBAN").agg(latest).select("WBAN", *[F.col(f"_row.{c}").alias(c) for c in attrs])


def keep_stations(df: DataFrame, ids: DataFrame, broadcast: bool = False) -> DataFrame:
    """Rows of ``df`` whose WBAN is in ``ids``: a left-semi join.

    A semi join never duplicates a row even if ``ids`` repeats a station.
    ``broadcast`` only after the side's size was proven (see
    :meth:`WeatherTables.station_fits` and :func:`row_count_at_most`).
    """
    return df.join(_side(ids.select("WBAN"), broadcast), "WBAN", "left_semi")


def attach_station(df: DataFrame, station: DataFrame, state: str | None = None,
                   columns=None, how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Equi-join on WBAN with station attributes, optionally of one state.

    With a state the join is inner in effect (rows without a station of that
    state drop out), so it is written as an inner join.  Joining on the
    column name leaves a single ``WBAN`` column.
    """
    side = in_state(station, state)
    if columns is not None:
        side = side.select("WBAN", *[c for c in columns if c != "WBAN"])
    return df.join(_side(side, broadcast), "WBAN", how)


def group_codes(side: DataFrame, attrs) -> tuple[DataFrame, DataFrame]:
    """One INT code per group of station attributes (e.g. per ``State``).

    The code of a group is the smallest WBAN in it: deterministic (so every
    use and every recomputation agrees) and unique, since each station
    belongs to exactly one group.  Returns ``(WBAN, _code)`` per station and
    ``(_code, *attrs)`` per group.  Fact rows can then be grouped on an
    integer instead of carrying and hashing the attribute text.
    """
    code = F.min("WBAN").over(Window.partitionBy(*attrs))
    per_station = side.select("WBAN", code.alias("_code"))
    per_group = side.groupBy(*attrs).agg(F.min("WBAN").alias("_code"))
    return per_station, per_group
