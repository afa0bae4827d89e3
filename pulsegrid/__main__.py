"""Jobs of the station platform: ``python -m pulsegrid <raw|clean|curate|follow|compact|retain|export>``."""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from pulsegrid.plans.curate import curate
from pulsegrid.session import SQL_DEFAULTS
from pulsegrid.sources import compact, export_csv, kafka_stream, read_published, retain_days
from pulsegrid.streaming.jobs import INFO, STATUS, WEATHER
from pulsegrid.streaming import run_curation, start_station_clean, start_station_curated, start_station_raw, station_tables


def _arguments() -> argparse.ArgumentParser:
    env = os.environ.get
    parser = argparse.ArgumentParser(prog="pulsegrid", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    raw = jobs.add_parser("raw", help="message topics to the raw zone, until stopped")
    raw.add_argument("--servers", default=env("KAFKA_BOOTSTRAP"), help="Kafka bootstrap servers")
    raw.add_argument("--topic-prefix", default="", help="put before station_status, station_information and weather")
    raw.add_argument("--raw", required=True)

    clean = jobs.add_parser("clean", help="raw zone to clean zone")
    clean.add_argument("--raw", required=True)
    clean.add_argument("--clean", required=True)
    clean.add_argument("--once", action="store_true", help="process what is there and stop")

    cur = jobs.add_parser("curate", help="publish the curated snapshot periodically, rebuilt from all clean rows")
    cur.add_argument("--clean", required=True)
    cur.add_argument("--curated", required=True)
    cur.add_argument("--interval", type=float, default=float(env("BATCH_INTERVAL", "120")))
    cur.add_argument("--rounds", type=int, help="stop after this many rounds")

    follow = jobs.add_parser("follow", help="publish the curated snapshot from new clean rows only")
    follow.add_argument("--clean", required=True)
    follow.add_argument("--curated", required=True)
    follow.add_argument("--once", action="store_true", help="process what is there and stop")

    comp = jobs.add_parser("compact", help="rewrite many small files as few")
    comp.add_argument("--source", required=True)
    comp.add_argument("--target", required=True)
    comp.add_argument("--files", type=int)

    keep = jobs.add_parser("retain", help="delete raw date folders older than the retention period")
    keep.add_argument("--raw", required=True)
    keep.add_argument("--days", type=int, default=30)
    keep.add_argument("--today", help="ISO date to count from (default: today)")

    exp = jobs.add_parser("export", help="curated snapshot as CSV")
    exp.add_argument("--curated", required=True)
    exp.add_argument("--target", required=True)
    exp.add_argument("--single-file", action="store_true")
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    parser = _arguments()
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName(f"pulsegrid-{args.job}")
    for name, value in SQL_DEFAULTS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()

    if args.job == "raw":
        if not args.servers:
            parser.error("--servers or KAFKA_BOOTSTRAP is required")
        start_station_raw(lambda kind: kafka_stream(spark, args.servers, args.topic_prefix + kind), args.raw)
        spark.streams.awaitAnyTermination()
    elif args.job == "clean":
        running = start_station_clean(spark, args.raw, args.clean, every=None if args.once else "30 seconds")
        if args.once:
            for query in running:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    elif args.job == "curate":
        good = run_curation(lambda: curate(*station_tables(spark, args.clean)), args.curated, args.interval, args.rounds)
        return 0 if good else 1
    elif args.job == "follow":
        every = None if args.once else "120 seconds"
        start_station_curated(spark, args.clean, args.curated, every).awaitTermination()
    elif args.job == "compact":
        compact(spark, args.source, args.target, files=args.files)
    elif args.job == "retain":
        today = args.today or date.today().isoformat()
        for kind in (STATUS, INFO, WEATHER):
            print(kind, *retain_days(spark, f"{args.raw.rstrip('/')}/{kind}", today, args.days))
    elif args.job == "export":
        snapshot = read_published(spark, args.curated)
        if snapshot is None:
            print(f"nothing published at {args.curated}", file=sys.stderr)
            return 1
        export_csv(snapshot, args.target, args.single_file)
    return 0


if __name__ == "__main__":
    sys.exit(main())
