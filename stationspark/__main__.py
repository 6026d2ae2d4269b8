"""Command line: run one query over station data and show or write the result.

  python -m stationspark --data ROOT [--layout month-files|partitioned|fixtures] QUERY [args]

Layouts: ``month-files`` is ``ROOT/yyyymm/{kind}.txt`` as distributed,
``partitioned`` the Parquet layer written by ``ingest`` (or by
``sources.sinks.write_tables``), ``maintained`` the partials beside such a layer
(aggregate questions only), ``fixtures`` the driver's test tables.
Results are shown whole (``--show N``: the first N rows) or written as JSON
lines by the executors (``--out PATH``), the way for large ones.
"""

from __future__ import annotations

import argparse
import sys

from stationspark.plans import converted, maintained
from stationspark.plans import queries as q
from stationspark.session import build_session
from stationspark.sources import clustered, fixtures, manifest, readers, sinks
from stationspark.streaming import ingest, versioned

# Questions that partials answer.
AGGREGATES = ("avg", "monthly-temp", "hourly", "extrema", "unreliable")


def _tables(spark, args):
    if args.layout == "month-files":
        return readers.load_month_files(spark, args.data, year=args.year)
    if args.layout == "partitioned":
        return readers.load_partitioned(spark, args.data, year=args.year)
    if args.layout == "maintained":
        if args.query not in AGGREGATES:
            raise SystemExit(f"{args.query}: not answered from partials, only {', '.join(AGGREGATES)}")
        return maintained.load(spark, args.data, year=args.year)
    return fixtures.load(spark, args.data)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stationspark", description=__doc__.split("\n\n")[0])
    p.add_argument("--data", required=True, help="data root")
    p.add_argument("--layout", default="month-files", choices=["month-files", "partitioned", "maintained", "fixtures"])
    p.add_argument("--year", type=int, default=2013)
    p.add_argument("--master", default="local[*]")
    p.add_argument("--show", type=int, help="show only so many rows (default: the whole result)")
    p.add_argument("--out", help="write JSON lines here instead of showing")
    sub = p.add_subparsers(dest="query", required=True)

    s = sub.add_parser("avg", help="Q1 mean of a metric for a state and month range")
    s.add_argument("state"), s.add_argument("month_start", type=int), s.add_argument("month_end", type=int)
    s.add_argument("metric", nargs="?", default="AvgTemp")
    s.add_argument("--by-state-month", action="store_true")
    s.add_argument("--unit", help="unit of the result, such as °C")
    s = sub.add_parser("monthly-temp", help="Q2 national mean temperature in °C")
    s.add_argument("month", type=int, nargs="?"), s.add_argument("--offset", type=float, default=32.0)
    s = sub.add_parser("anomalous", help="Q3 anomalous days of a month")
    s.add_argument("month", type=int)
    s.add_argument("--count", action="store_true", help="only how many")
    s = sub.add_parser("agri", help="Q4 good farming days of a month")
    s.add_argument("month", type=int), s.add_argument("--wban", type=int)
    s.add_argument("--count", action="store_true", help="only how many")
    s.add_argument("--stations", action="store_true", help="only the stations that have one")
    s = sub.add_parser("stations", help="Q5 station ids of a state")
    s.add_argument("state")
    s = sub.add_parser("hourly", help="Q6 hour-of-day profile")
    s.add_argument("state"), s.add_argument("month", type=int)
    s.add_argument("metric", nargs="?", default="DryBulbFarenheit"), s.add_argument("--wban", type=int)
    s.add_argument("--include-on-hour", action="store_true")
    s = sub.add_parser("extrema", help="Q7 stations with the min and max of a metric")
    s.add_argument("kind", help="daily|hourly|monthly or 1|2|3"), s.add_argument("state")
    s.add_argument("month", type=int), s.add_argument("metric")
    s.add_argument("--unit", help="unit of the result, such as km/h")
    s = sub.add_parser("unreliable", help="Q8 stations with most suspect values")
    s.add_argument("month_start", type=int), s.add_argument("month_end", type=int)
    s.add_argument("--state"), s.add_argument("-k", type=int, default=10)
    s.add_argument("--by-state", action="store_true", help="the k of every state")
    s = sub.add_parser("catalog", help="Q9 metrics of a record kind")
    s.add_argument("type_id", nargs="?", default="3")
    s = sub.add_parser("ingest", help="load new month files into the partitioned Parquet layer")
    s.add_argument("out_root")
    s.add_argument("--corrections", action="store_true",
                   help="files may be delivered again, corrected: latest wins, history and partials are kept")
    s = sub.add_parser("partials", help="build the partials of the loaded tables")
    s.add_argument("out_root")
    s = sub.add_parser("cluster", help="write a table clustered by station inside each month")
    s.add_argument("kind"), s.add_argument("out_root"), s.add_argument("--rows-per-range", type=int, default=clustered.ROWS_PER_RANGE)
    sub.add_parser("manifest", help="write the sizes of a Parquet layer beside it")
    s = sub.add_parser("clean", help="write the loaded tables as the clean, typed layer")
    s.add_argument("out_root")
    return p


def _build(spark, args):
    if args.query == "catalog":
        return q.metric_catalog(spark, args.type_id)
    t = _tables(spark, args)
    of = maintained if args.layout == "maintained" else q
    if getattr(args, "unit", None) and of is maintained:
        raise SystemExit("--unit: not with the maintained layout")
    if args.query == "avg":
        months = args.month_start, args.month_end
        if args.unit and args.by_state_month:
            return converted.station_metric_avg_by_state_month(t, args.metric, args.unit, "monthly", *months)
        if args.unit:
            return converted.station_metric_avg(t, args.state, *months, args.metric, args.unit, digits=2)
        if args.by_state_month:
            return of.station_metric_avg_by_state_month(t, *months, args.metric)
        return of.station_metric_avg(t, args.state, *months, args.metric, digits=2)
    if args.query == "monthly-temp":
        return of.monthly_avg_temperature(t, args.month, args.offset, digits=2)
    if args.query == "anomalous":
        if args.count:
            return q.anomalous_days_count(t, args.month)
        return q.anomalous_days_formatted(t, args.month)
    if args.query == "agri":
        if args.count:
            return q.agri_days_count(t, args.month, args.wban)
        if args.stations:
            return q.agri_days_stations(t, args.month, wban=args.wban)
        return q.agri_days_formatted(t, args.month, args.wban)
    if args.query == "stations":
        return q.station_ids(t, args.state)
    if args.query == "hourly":
        return of.hourly_profile(t, args.state, args.month, args.metric, args.wban, args.include_on_hour)
    if args.query == "extrema":
        if args.unit:
            return converted.metric_extrema(t, args.kind, args.state, args.month, args.metric, args.unit)
        return of.metric_extrema(t, args.kind, args.state, args.month, args.metric)
    if args.by_state:
        return of.unreliable_stations_by_state(t, args.month_start, args.month_end, args.k)
    return of.unreliable_stations(t, args.month_start, args.month_end, args.state, args.k)


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master)
    if args.query == "ingest" and args.corrections:
        versioned.ingest_available(spark, args.data, args.out_root)
        return 0
    if args.query == "partials":
        print(maintained.build(_tables(spark, args), args.out_root, args.year))
        return 0
    if args.query == "cluster":
        fact = _tables(spark, args).fact(args.kind)
        ranges = clustered.ranges_for(fact.count(), args.rows_per_range)
        print(clustered.write(fact, f"{args.out_root.rstrip('/')}/{args.kind}", ranges))
        return 0
    if args.query == "manifest":
        print(manifest.write(spark, args.data))
        return 0
    if args.query == "ingest":
        done = ingest.ingest_available(spark, args.data, args.out_root)
        print(done)
        return 0
    if args.query == "clean":
        print(sinks.write_clean(_tables(spark, args), args.out_root, year=args.year))
        return 0
    df = _build(spark, args)
    if args.out:
        sinks.write_records(df, args.out)
    else:
        df.show(df.count() if args.show is None else args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
