"""Command line for ``spark-submit`` or ``python -m paytally``.

    load ROOT YEAR [MONTH [DAY]]           load a period
    load-file PATH                         load one file or folder
    ingest LANDING ARCHIVE CHECKPOINT      load what has landed since the last run
    report METRIC DAY N                    print a top-N report
    clean                                  delete versions of days that were replaced
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from paytally.plans import report, run_period
from paytally.plans.reports import REPORTS
from paytally.schema import TABLES
from paytally.session import build_session, settings_for
from paytally.sinks import JdbcTarget, Warehouse
from paytally.sources import period_path
from paytally.streaming import ingest_available
from paytally.streaming.ingest import STEP_BYTES


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="paytally", description="Daily payment activity")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--warehouse", help="folder of the result tables")
    target.add_argument("--jdbc-url", help="database of the result tables")
    parser.add_argument(
        "--jdbc-option", action="append", default=[], metavar="KEY=VALUE", help="driver, user, ..."
    )
    parser.add_argument(
        "--jdbc-bounds",
        action="append",
        default=[],
        metavar="TABLE:COLUMN:LOWER:UPPER",
        help="read that table over several connections",
    )
    parser.add_argument("--database", default="paytally", help="their catalog database")
    parser.add_argument("--user-buckets", type=int, help="buckets of a new users table")
    parser.add_argument(
        "--input-bytes", type=int, help="size of the text to load, to size the partitions"
    )
    jobs = parser.add_subparsers(dest="job", required=True)

    load = jobs.add_parser("load", help="load a year, a month or a day")
    load.add_argument("root")
    load.add_argument("year")
    load.add_argument("month", nargs="?")
    load.add_argument("day", nargs="?")
    load.add_argument("--prefix", default="payments", help="start of the file names")

    load_file = jobs.add_parser("load-file", help="load one file or folder")
    load_file.add_argument("path")
    for job in (load, load_file):
        job.add_argument("--tables", nargs="+", choices=list(TABLES), default=list(TABLES))

    ingest = jobs.add_parser("ingest", help="load what has landed since the last run")
    ingest.add_argument("landing")
    ingest.add_argument("archive")
    ingest.add_argument("checkpoint")
    ingest.add_argument("--step-bytes", type=int, default=STEP_BYTES, help="text to load at once")

    jobs.add_parser("clean", help="when no load is under way: delete what is not published")

    top = jobs.add_parser("report", help="print a top-N report of a day")
    top.add_argument("metric", choices=list(REPORTS))
    top.add_argument("day")
    top.add_argument("n", type=int)
    return parser.parse_args(argv)


def target_of(spark: SparkSession, args: argparse.Namespace) -> Warehouse | JdbcTarget:
    if args.warehouse:
        return Warehouse(spark, args.warehouse, args.database, args.user_buckets)
    options = dict(option.split("=", 1) for option in args.jdbc_option)
    parts = (bound.split(":") for bound in args.jdbc_bounds)
    bounds = {table: (column, lower, upper) for table, column, lower, upper in parts}
    return JdbcTarget(spark, args.jdbc_url, options, bounds)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(settings=settings_for(args.input_bytes) if args.input_bytes else None)
    warehouse = target_of(spark, args)
    if args.job == "load":
        source = period_path(args.root, args.year, args.month, args.day, args.prefix)
        print(run_period(spark, source, warehouse, args.tables))
    elif args.job == "load-file":
        print(run_period(spark, args.path, warehouse, args.tables))
    elif args.job == "ingest":
        for counts in ingest_available(
            spark, args.landing, args.archive, args.checkpoint, warehouse, args.step_bytes
        ):
            print(counts)
    elif args.job == "clean":
        if not isinstance(warehouse, Warehouse):
            raise SystemExit("only a warehouse of files has versions to delete")
        print(warehouse.drop_unused())
    else:
        report(warehouse, args.metric, args.day, args.n).show(args.n, truncate=False)


if __name__ == "__main__":
    main()
