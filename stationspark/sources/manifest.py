"""Manifest of a layer: proven sizes, kept beside the tables.

For each table: rows, rows of every month, least and greatest station, and for
the station table the number of stations.  It is made by the write, or later
from a layer as it is, in one job.  A loader reads it without a job and knows
while planning whether the station side may be broadcast.

A manifest speaks of the files that it was made from: their names (a writer
never uses one twice) are part of it.  Where a table's files are others now,
it proves nothing and sizes are counted as without one.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationspark.sources import files
from stationspark.sources.readers import FACTS, STATION_MONTHS, load_partitioned, read_partitioned
from stationspark.sources.schemas import KINDS, PARTITION_COLUMN
from stationspark.sources.tables import WeatherTables

NAME = "_manifest.json"


def path_of(root: str) -> str:
    return f"{root.rstrip('/')}/{NAME}"


def fingerprint(df: DataFrame) -> str:
    """Of the names of a table's files."""
    names = sorted(f.rsplit("/", 1)[-1] for f in df.inputFiles())
    return hashlib.sha256("\n".join(names).encode()).hexdigest()


def describe(df: DataFrame, kind: str) -> dict:
    """Sizes and key bounds of one table: one aggregation, a row for each month."""
    months = [PARTITION_COLUMN] if PARTITION_COLUMN in df.columns else []
    sizes = df.groupBy(*months).agg(F.count(F.lit(1)).alias("rows"), F.min("WBAN").alias("least"),
                                    F.max("WBAN").alias("most"))
    out = [r.asDict() for r in sizes.collect()]
    known = [r for r in out if r["least"] is not None]
    found = {"files": fingerprint(df), "rows": sum(r["rows"] for r in out),
             "least_wban": min((r["least"] for r in known), default=None),
             "most_wban": max((r["most"] for r in known), default=None),
             "months": {str(r[PARTITION_COLUMN]): r["rows"] for r in out} if months else {}}
    if kind == "station":
        found["stations"] = df.select("WBAN").distinct().count()
    return found


def write(spark: SparkSession, root: str, kinds=KINDS) -> dict:
    """Describes the Parquet tables that the layer has, and keeps it at ``root``."""
    found = {}
    for kind in kinds:
        if files.exists(spark, f"{root.rstrip('/')}/{kind}"):
            found[kind] = describe(read_partitioned(spark, root, kind), kind)
    files.write_text(spark, path_of(root), json.dumps(found, indent=1, sort_keys=True))
    return found


def read(spark: SparkSession, root: str) -> dict:
    """The manifest at ``root``; empty where there is none."""
    where = path_of(root)
    return json.loads(files.read_text(spark, where)) if files.exists(spark, where) else {}


def proven(spark: SparkSession, root: str, kind: str, manifest: dict | None = None, schema=None) -> dict | None:
    """What the manifest says of a table, if its files are those it was made from."""
    own = (read(spark, root) if manifest is None else manifest).get(kind)
    if own is None or not files.exists(spark, f"{root.rstrip('/')}/{kind}"):
        return None
    return own if fingerprint(read_partitioned(spark, root, kind, schema=schema)) == own["files"] else None


def load(spark: SparkSession, root: str, schemas: dict, year: int = 2013, station_months=STATION_MONTHS,
         kinds=FACTS) -> WeatherTables:
    """``load_partitioned`` with the sizes that the manifest proves.

    With the tables' ``schemas`` no footer is read: until an action nothing
    runs on the cluster.
    """
    tables = load_partitioned(spark, root, year=year, station_months=station_months, kinds=kinds, schemas=schemas)
    found = proven(spark, root, "station", schema=schemas.get("station"))
    if found is not None:
        tables._rows["station"] = found["stations"]
    return tables
