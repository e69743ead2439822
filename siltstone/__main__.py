"""Command line of the jobs, for spark-submit or python -m siltstone.

    silver_events --root s3a://lake/media --ingested_date 2024-01-02
    visitor_state --root s3a://lake/media --ingested_date 2024-01-02
    extract --url jdbc:sqlserver://… --properties login.json --out s3a://lake/bronze
    export_calls --pages s3a://lake/landed/calls --out s3a://lake/calls
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas, session
from siltstone.functions.columns import run_stamp
from siltstone.plans import visitor_state
from siltstone.plans.backfill import backfill
from siltstone.plans.calls import export_calls
from siltstone.plans.jobs import JOBS, run
from siltstone.sources.partitions import read_partition, read_table, run_date
from siltstone.sources.relational import (
    HASH_PARTITIONS,
    SOURCE_TABLES,
    extract_tables,
    read_relational,
)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="siltstone")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in sorted(JOBS):
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True, help="folder with bronze/, silver/ and gold/")
        job.add_argument("--ingested_date", help="YYYY-MM-DD, by default today in UTC")
        if not JOBS[name].whole:
            job.add_argument("--backfill", action="store_true", help="all dates that are missing or whose inputs changed")
        if name == "gold_media_details":
            job.add_argument("--base_url", required=True, help="prefix of default media URLs")
    state = jobs.add_parser("visitor_state", help="put a date of silver/events into the bucketed visitor state")
    state.add_argument("--root", required=True)
    state.add_argument("--ingested_date", help="YYYY-MM-DD, by default today in UTC")
    extract = jobs.add_parser("extract")
    extract.add_argument("--url", required=True)
    extract.add_argument("--tables", nargs="+", default=list(SOURCE_TABLES))
    extract.add_argument("--schema", default="dbo")
    extract.add_argument("--properties", help="JSON file with JDBC properties")
    extract.add_argument(
        "--hash_field",
        nargs="+",
        default=[],
        metavar="TABLE=COLUMN",
        help="columns to read tables in slices by",
    )
    extract.add_argument("--slices", type=int, default=HASH_PARTITIONS)
    extract.add_argument("--out", required=True)
    calls = jobs.add_parser("export_calls")
    calls.add_argument("--pages", required=True, help="Parquet table of landed pages")
    calls.add_argument("--out", required=True)
    return parser.parse_args(argv)


def _extract(spark: SparkSession, args: argparse.Namespace) -> None:
    properties = json.loads(Path(args.properties).read_text()) if args.properties else {}
    prefix = f"{args.schema}." if args.schema else ""
    fields = dict(pair.split("=", 1) for pair in args.hash_field)

    def read(table: str) -> DataFrame:
        return read_relational(
            spark, args.url, prefix + table, properties, fields.get(table), args.slices
        )

    extract_tables(spark, args.tables, read, args.out)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO)
    day = run_date(getattr(args, "ingested_date", None))
    spark = session.create()
    try:
        if args.job == "extract":
            _extract(spark, args)
        elif args.job == "visitor_state":
            events = read_partition(spark, f"{args.root}/silver/events", day, schemas.SILVER_EVENTS)
            visitor_state.update(spark, f"{args.root}/gold/visitor_state", events, day)
        elif args.job == "export_calls":
            stamp = spark.range(1).select(run_stamp(F.current_timestamp())).first()[0]
            export_calls(read_table(spark, args.pages), args.out, stamp)
        else:
            options = {"base_url": args.base_url} if "base_url" in args else {}
            if getattr(args, "backfill", False):
                backfill(spark, args.job, args.root, **options)
            else:
                run(spark, args.job, args.root, day, **options)
    finally:
        session.drop_scratch(spark)


if __name__ == "__main__":
    main()
