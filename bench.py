"""Benchmark the headline queries.

Runs every registered query of the library over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:

  {"metric": "total_query_seconds", "value": N, "unit": "sec",
   "queries": {"name": sec, ...}, "sf": ...}

Each query runs once to warm up, then ``$BENCH_REPEAT`` times (default 5);
the reported time is the median.  Results are consumed by the ``noop``
sink, so the full plan executes on the executors without a driver collect.

``BENCH_LAYOUT=partitioned`` first writes the weather tables into the
month-partitioned Parquet layer (time reported as ``ingest_sec``) and runs
the same queries over it, as a deployment would; the default runs them over
views derived from the driver tables on every query.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationspark.plans import layers, registry  # noqa: E402
from stationspark.session import build_session, scratch_path  # noqa: E402
from stationspark.sources import fixtures, readers, sinks  # noqa: E402


# Fixed headline set of the first round; its total stays comparable.  The other
# registered queries of the library are timed as well and reported beside it.
HEADLINE = [
    "station_metric_avg", "station_metric_avg_by_state_month", "monthly_avg_temp_c",
    "monthly_avg_temp_c_offset31", "anomalous_days", "anomalous_days_formatted",
    "anomalous_days_count", "agri_days", "agri_days_formatted", "agri_days_station",
    "agri_days_stations", "station_ids", "hourly_profile", "hourly_profile_station",
    "hourly_profile_by_state", "metric_extrema_daily", "metric_extrema_hourly",
    "metric_extrema_monthly", "metric_extrema_by_state", "unreliable_top10_all",
    "unreliable_top10_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          app_name="stationspark-bench",
                          extra={"spark.driver.memory": "8g"})
    partitioned = os.environ.get("BENCH_LAYOUT", "views") == "partitioned"
    known = registry.COMPOSITE if partitioned else registry.queries()
    # the queries over kept layers are timed only when named: writing their layers takes long
    names = only or HEADLINE + [n for n in known if n not in HEADLINE and n not in layers.registered()]
    extra = {}
    if partitioned:
        t0 = time.perf_counter()
        root = sinks.write_clean(fixtures.build(spark, sf_dir), scratch_path(spark, "bench-layer"))
        extra["ingest_sec"] = round(time.perf_counter() - t0, 4)
        extra["layout"] = "partitioned"
        tables = readers.load_partitioned(spark, root)
        build = {name: (lambda t=tables, f=registry.COMPOSITE[name]: f(t)) for name in names}
    else:
        all_queries = registry.queries()
        build = {name: (lambda f=all_queries[name]: f(spark, sf_dir)) for name in names}

    def run(name: str) -> float:
        t0 = time.perf_counter()
        build[name]().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:
        run(name)
    times = {name: round(statistics.median(run(name) for _ in range(repeat)), 4)
             for name in names}
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(t for n, t in times.items() if only or n in HEADLINE), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(match.group(1)) if match else sf_dir,
        "all_queries_sec": round(sum(times.values()), 4),
        **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
