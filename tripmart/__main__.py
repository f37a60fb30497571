"""Command line: land files, or build the warehouse from landed files."""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tripmart.operators import extract_links
from tripmart.plans import build
from tripmart.registry import DEFAULT_VEHICLE_TYPES, FHV_FACT_TABLE, TAXI_FACT_TABLE, VEHICLE_TYPES
from tripmart.sources import ingest
from tripmart.sources.landing import raw_path


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tripmart", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    land = commands.add_parser("ingest", help="land monthly files; without years, the newest published month")
    land.add_argument("--source", required=True, help="folder that holds the published files")
    land.add_argument("--dest", required=True, help="bucket or folder; files land below its raw/")
    land.add_argument("--vehicle-type", nargs="+", choices=VEHICLE_TYPES, default=list(DEFAULT_VEHICLE_TYPES))
    land.add_argument("--year", nargs="+", type=int)
    land.add_argument("--month", type=int)
    land.add_argument("--pages", help="saved pages of the publisher; only files linked there are wanted")
    land.add_argument("--base-url", help="what a published link begins with; needed with --pages")
    land.add_argument("--raise-if-any-not-found", action="store_true")
    land.add_argument("--raise-if-any-rejected", action="store_true")
    land.add_argument("--only-new", action="store_true", help="leave files alone that have landed as they are")

    make = commands.add_parser("build", help="staging views and fact tables from landed files")
    make.add_argument("--landed", required=True, help="the --dest of ingest")
    make.add_argument("--zones", required=True, help="zone lookup CSV")
    make.add_argument("--location", help="folder for the tables")
    make.add_argument("--fact", nargs="+", choices=(TAXI_FACT_TABLE, FHV_FACT_TABLE))
    make.add_argument("--sample-limit", type=int, help="rows per staging view, for trial runs")
    make.add_argument("--sample-share", type=float, help="share of the trip keys, for trial runs")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    top = parser()
    args = top.parse_args(arguments)
    if args.command == "ingest" and args.pages and not args.base_url:
        top.error("--pages needs --base-url")
    spark = SparkSession.builder.appName(f"tripmart-{args.command}").getOrCreate()
    if args.command == "ingest":
        published = None
        if args.pages:
            pages = spark.read.text(args.pages, wholetext=True)
            published = extract_links(pages, "value", args.base_url)
        report = ingest(
            spark, args.source, args.dest, args.vehicle_type, args.year, args.month,
            published=published,
            strict=args.raise_if_any_not_found,
            on_error="raise" if args.raise_if_any_rejected else "report",
            only_new=args.only_new,
        )
        path = f"{args.dest.rstrip('/')}/reports/ingest-{uuid.uuid4().hex}"
        report.write.parquet(path)
        for row in spark.read.parquet(path).groupBy("status").count().orderBy("status").collect():
            print(f"{row['status']}: {row['count']}")
        print(f"report: {path}")
    else:
        facts = args.fact or (TAXI_FACT_TABLE, FHV_FACT_TABLE)
        landed = {feed: raw_path(args.landed, feed) for feed in VEHICLE_TYPES}
        build(spark, landed, args.zones, facts, args.sample_limit, args.location, args.sample_share)


if __name__ == "__main__":
    main()
