"""Station-weather queries on Spark DataFrames.

Layout: ``sources`` (schemas, catalog, readers, fixture views), ``functions``
(column expressions, parameter checks), ``operators`` (station joins,
two-level aggregation, top-k), ``plans`` (the public queries) and
``streaming`` (incremental ingest of arriving month files).
"""

from stationspark.plans import queries
from stationspark.sources.tables import WeatherTables

__all__ = ["queries", "WeatherTables"]
