"""Command line: the daily procedure and the backfill as Spark jobs.

    python -m pacecast run-day  --base-day 1998-04-01 --tables DIR --target PATH
    python -m pacecast backfill --first 1998-03-01 --last 1998-12-01 --tables DIR --target PATH

``--tables`` is a folder with the source tables as Parquet; ``--target`` the
date-partitioned forecast table (its earlier month feeds last month's
accuracy). Without ``--target`` the rows are printed. Use ``spark-submit``
on a cluster; ``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse

from .plans.pipeline import backfill, run_day
from .session import build_session
from .sources.standins import read_facts
from .sources.tables import TableSet


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m pacecast")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run-day", help="recompute yesterday, or the previous month on the 1st")
    run.add_argument("--base-day", required=True)
    fill = sub.add_parser("backfill", help="what the runs on FIRST..LAST do, in one job")
    fill.add_argument("--first", required=True)
    fill.add_argument("--last", required=True)
    for p in (run, fill):
        where = p.add_mutually_exclusive_group(required=True)
        where.add_argument("--tables", help="folder of the test tables (stand-in facts)")
        where.add_argument("--facts", help="folder with one Parquet table per metric fact")
        p.add_argument("--as-of", default=None, help="ignore source days from this day on")
        p.add_argument("--target", default=None)
        p.add_argument("--own-month-shift", action="store_true",
                       help="align month -3 by its own length difference")
        p.add_argument("--master", default=None)
        p.add_argument("--show", type=int, default=20)
        p.add_argument("--explain", action="store_true",
                       help="print the formatted physical plan of the final job")
    args = parser.parse_args(argv)

    if args.master:
        spark = build_session(master=args.master)
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName("pacecast").getOrCreate()
    source = read_facts(spark, args.facts) if args.facts else TableSet(spark, args.tables)
    if args.command == "run-day":
        rows = run_day(spark, source, args.base_day, target=args.target,
                       own_month_shift=args.own_month_shift, as_of=args.as_of)
    else:
        rows = backfill(spark, source, args.first, args.last, target=args.target,
                        own_month_shift=args.own_month_shift, as_of=args.as_of)
    if args.explain:
        rows.explain(mode="formatted")
    if args.target is None:
        rows.show(args.show, truncate=False)
    else:
        print(f"stored {rows.count()} rows in {args.target}")


if __name__ == "__main__":
    main()
