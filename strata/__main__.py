"""Command line: ``python -m strata <command> --root <lake root> …``.

Commands mirror the lake's jobs: ``land`` (monthly files → bronze),
``silver``, ``gold`` (build + tests), ``review`` (layout, scan audit,
compaction), ``marts`` (dashboard frames) and ``coverage``. Results are
printed as JSON lines (bounded: one line per month / check / mart row).
"""

from __future__ import annotations

import argparse
import json
import sys

from strata.operators import marts
from strata.plans import jobs, layout
from strata.plans.tables import Lake
from strata.session import apply_scale, build_session
from strata.sources import months, trips


def _emit(df) -> None:
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strata")
    parser.add_argument("--root", required=True, help="lake root (shared storage URI)")
    parser.add_argument("--prefix", default="", help="namespace prefix")
    parser.add_argument("--master", default=None)
    sub = parser.add_subparsers(dest="command", required=True)

    land = sub.add_parser("land", help="land monthly raw files into bronze (+ silver)")
    land.add_argument("files", nargs="+")
    land.add_argument("--start")
    land.add_argument("--end")

    silver = sub.add_parser("silver", help="bronze months → silver")
    silver.add_argument("--start")
    silver.add_argument("--end")
    silver.add_argument("--on-all-rejected", choices=("keep", "clear"), default="keep")

    gold = sub.add_parser("gold", help="build gold and run its tests")
    gold.add_argument("--zones", required=True, help="zone lookup CSV")

    review = sub.add_parser("review", help="layout + scan audit (+ compaction)")
    review.add_argument("--month", required=True)
    review.add_argument("--no-compact", action="store_true")

    mart = sub.add_parser("marts", help="dashboard frames")
    mart.add_argument("--months", nargs="*", default=None)
    mart.add_argument("--limit", type=int, default=10)

    cov = sub.add_parser("coverage", help="planned months vs landed bronze")
    cov.add_argument("--start")
    cov.add_argument("--end")

    args = parser.parse_args(argv)
    spark = build_session(args.master, app_name=f"strata-{args.command}")
    lake = Lake(spark, args.root.rstrip("/"), prefix=args.prefix)
    jobs.bootstrap(lake)
    jobs.attach(lake)

    if args.command == "land":
        by_month = jobs.paths_by_month(args.files)
        apply_scale(spark, args.files)
        if args.start or args.end:
            _emit(jobs.backfill_files(lake, by_month, start=args.start, end=args.end))
        else:
            bronze = jobs.bronze_from_files(spark, args.files, loaded_at=jobs.utc_now_iso())
            print(json.dumps(jobs.land_bronze(lake, bronze)))
    elif args.command == "silver":
        apply_scale(spark, [lake.table("bronze", jobs.TRIPS).location])
        wanted = months.month_strings(*months.resolve_range(args.start, args.end)) if (args.start or args.end) else None
        _emit(jobs.build_silver(lake, wanted, on_all_rejected=args.on_all_rejected))
    elif args.command == "gold":
        apply_scale(spark, [lake.table("silver", jobs.TRIPS).location])
        _emit(jobs.run_gold(lake, trips.read_zone_seed(spark, args.zones), fail_on_error=False))
    elif args.command == "review":
        tables = {"bronze.yellow_taxi_trips": lake.table("bronze", jobs.TRIPS),
                  "silver.yellow_taxi_trips": lake.table("silver", jobs.TRIPS)}
        for name, df in layout.review(tables, args.month, compact=not args.no_compact).items():
            print(json.dumps({"section": name}))
            _emit(df)
    elif args.command == "marts":
        fact, zones, dates = jobs.gold_tables(lake)
        frames = {
            "daily_trip_volume": marts.daily_trip_volume(fact, args.months),
            "monthly_revenue": marts.monthly_revenue(fact, args.months),
            "top_pickup_zones": marts.zone_labels(fact, zones, args.months, args.limit),
            "trips_by_payment_type": marts.payment_mix(fact, args.months),
            "avg_fare_by_day_of_week": marts.avg_fare_by_day_of_week(fact, dates, args.months),
            "kpis": marts.dashboard_kpis(fact, args.months),
        }
        for name, df in frames.items():
            print(json.dumps({"section": name}))
            _emit(df)
    elif args.command == "coverage":
        planned = months.month_range(spark, args.start, args.end)
        _emit(jobs.backfill_coverage(lake, planned))
    return 0


if __name__ == "__main__":
    code = main()
    from pyspark.sql import SparkSession

    active = SparkSession.getActiveSession()
    if active is not None:
        active.stop()
    sys.exit(code)
