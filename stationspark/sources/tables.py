"""The set of tables every query runs over."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class WeatherTables:
    """Station dimension plus fact tables, each fact partitioned by ``month``.

    ``station`` must hold one row per ``WBAN`` (the loaders guarantee it;
    see :func:`stationspark.operators.stations.latest_station_rows`).
    Facts hold typed keys and text metrics (the raw layer).
    """

    station: DataFrame
    daily: DataFrame | None = None
    hourly: DataFrame | None = None
    monthly: DataFrame | None = None
    precip: DataFrame | None = None
    remarks: DataFrame | None = None
    # Proven station-count bounds, filled lazily by ``station_fits``.  Not an
    # init field: ``dataclasses.replace`` (e.g. with another station table)
    # starts with an empty cache instead of inheriting a stale proof.
    _fits: dict = field(default_factory=dict, init=False, compare=False, repr=False)
    _states: dict = field(default_factory=dict, init=False, compare=False, repr=False)
    # Row bounds that a manifest proves, by table; see ``sources.manifest``.
    _rows: dict = field(default_factory=dict, init=False, compare=False, repr=False)

    def fact(self, kind: str) -> DataFrame:
        names = [f.name for f in fields(self) if f.name != "station" and not f.name.startswith("_")]
        if kind not in names:
            raise ValueError(f"unknown fact kind {kind!r}; expected one of {names}")
        df = getattr(self, kind)
        if df is None:
            raise ValueError(f"no {kind} table was loaded")
        return df

    def station_fits(self, max_rows: int | None) -> bool:
        """True when the whole station dimension has at most ``max_rows`` rows.

        Proven by the layer's manifest, or checked once per table set (one
        count of the dimension).  Any filter
        or projection of the dimension is then bounded too, so every station
        side may be broadcast.
        """
        if not max_rows:
            return False
        if self._rows.get("station", max_rows + 1) <= max_rows:
            return True
        if max_rows not in self._fits:
            from stationspark.operators.stations import row_count_at_most
            self._fits[max_rows] = row_count_at_most(self.station, max_rows)
        return self._fits[max_rows]

    def has_state(self, state: str) -> bool:
        """Whether a station of the dimension is in ``state``; looked up once per
        table set and state, stopping at the first station found."""
        if state not in self._states:
            from stationspark.operators.stations import in_state
            self._states[state] = not in_state(self.station, state).isEmpty()
        return self._states[state]
