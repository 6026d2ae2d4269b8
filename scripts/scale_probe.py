"""How query time grows with data: the Parquet layer at 1x and Nx the rows.

Usage: python scripts/scale_probe.py [sf_dir] [factor]

Writes the weather views of ``sf_dir`` into the month-partitioned Parquet
layer twice (below the shared checkpoint folder): as they are, and with every
fact row repeated ``factor`` times (a generator, not a join), split over
``factor`` files per month so the scan is parallel.  Then times the headline
queries on both layers (median of 3 after a warm-up) and prints one JSON line.
Means are unchanged by the repetition; counts grow by ``factor``.
"""

from __future__ import annotations

import json
import statistics
import sys
import time

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from stationspark.plans import registry  # noqa: E402
from stationspark.session import build_session, scratch_path  # noqa: E402
from stationspark.sources import fixtures, readers, sinks  # noqa: E402
from stationspark.sources.tables import WeatherTables  # noqa: E402

NAMES = ["station_metric_avg", "station_metric_avg_by_state_month", "monthly_avg_temp_c",
         "anomalous_days", "agri_days", "hourly_profile", "hourly_profile_by_state",
         "metric_extrema_daily", "metric_extrema_by_state", "unreliable_top10_all"]


def repeated(df, factor: int):
    copies = F.explode(F.sequence(F.lit(1), F.lit(factor))).alias("_copy")
    return df.select("*", copies).repartition(factor, "_copy").drop("_copy")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    factor = int(argv[2]) if len(argv) > 2 else 10
    spark = build_session()
    base = fixtures.build(spark, sf_dir)
    layers = {}
    for n, tables in ((1, base), (factor, WeatherTables(
            station=base.station, daily=repeated(base.daily, factor),
            hourly=repeated(base.hourly, factor), monthly=repeated(base.monthly, factor)))):
        root = sinks.write_tables(tables, scratch_path(spark, f"scale-x{n}"))
        layers[n] = readers.load_partitioned(spark, root)

    def run(tables, name):
        t0 = time.perf_counter()
        registry.COMPOSITE[name](tables).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    out = {}
    for name in NAMES:
        row = {}
        for n, tables in layers.items():
            run(tables, name)
            row[f"x{n}"] = round(statistics.median(run(tables, name) for _ in range(3)), 3)
        out[name] = row
    totals = {k: round(sum(r[k] for r in out.values()), 3) for k in next(iter(out.values()))}
    print(json.dumps({"sf_dir": sf_dir, "factor": factor, "totals": totals, "queries": out}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
