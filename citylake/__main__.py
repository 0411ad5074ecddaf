"""Job entry point for spark-submit.

    spark-submit -m citylake build --trips 's3://lake/landing/trips/*.parquet' \
        --weather 's3://lake/landing/weather/*.json' --zones s3://lake/landing/zones.csv \
        --out s3://lake/warehouse [--full-refresh]

    spark-submit -m citylake stream --landing s3://lake/landing/trips \
        --bronze s3://lake/warehouse/bronze/raw_taxi_trips --silver s3://lake/warehouse/silver/stg_taxi_trips

The session comes from the cluster configuration (``getOrCreate``); library defaults
only fill settings the cluster left unset.
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="citylake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("build", help="bronze files -> silver -> quality gate -> gold")
    p.add_argument("--trips", required=True, nargs="+")
    p.add_argument("--weather", required=True)
    p.add_argument("--zones", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--silver-layout", choices=("by_pickup_date", "versioned"), default="by_pickup_date")
    p.add_argument("--run-id", help="name of the run; a rerun under the same name continues it")
    p.add_argument("--no-bronze", action="store_true", help="do not append the trips to bronze first")
    p.add_argument("--check-gaps", action="store_true", help="also stop on missing weather hours (J5)")
    p.add_argument("--reload", action="store_true", help="load files again that the ledger knows unchanged")
    g = sub.add_parser("gold", help="bring gold up to the current silver tables (after a stream)")
    g.add_argument("--out", required=True)
    s = sub.add_parser("stream", help="availableNow incremental trip load")
    s.add_argument("--landing", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--checkpoint", help="folder of the stream's progress")
    s.add_argument("--max-files-per-trigger", type=int)
    args = ap.parse_args(argv)

    from citylake.session import configure, ensure_checkpoint_dir

    spark = configure(SparkSession.builder.appName(f"citylake-{args.cmd}").getOrCreate())
    ensure_checkpoint_dir(spark)
    if args.cmd == "build":
        from citylake.plans.materialize import build_warehouse
        from citylake.sinks import ledger
        from citylake.sources import files

        bronze_root = f"{args.out.rstrip('/')}/bronze/raw_taxi_trips"
        run_id = args.run_id or uuid.uuid4().hex
        landed = files.landed_files(spark, args.trips)
        if not (args.reload or args.no_bronze or args.silver_layout == "versioned"):
            found = ledger.sorted_out(spark, bronze_root, landed, run_id)
            landed = found["new"] + found["resent"]
            print(json.dumps({k: [f.path for f in v] for k, v in found.items()}))
        out = build_warehouse(
            spark,
            files.read_landed(spark, [f.path for f in landed]),
            files.read_weather(spark, args.weather),
            files.read_zones(spark, args.zones),
            args.out,
            full_refresh=args.full_refresh,
            silver_layout=args.silver_layout,
            run_id=run_id,
            files=landed,
            bronze=not args.no_bronze,
            check_gaps=args.check_gaps,
        )
        print(json.dumps(out, indent=2))
    elif args.cmd == "gold":
        from citylake.plans.materialize import refresh_gold

        print(json.dumps({"release": refresh_gold(spark, args.out).version}))
    else:
        from citylake.streaming.incremental import start_trip_stream

        q = start_trip_stream(spark, args.landing, args.bronze, args.silver,
                              checkpoint=args.checkpoint, max_files_per_trigger=args.max_files_per_trigger)
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
