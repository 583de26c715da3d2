"""Daily steps for spark-submit: ``extract``, ``load``, ``build``, ``check`` and ``plan-export``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from newsrisk.operators.quality import article_checks, daily_checks
from newsrisk.operators.upsert import EXPORTS, export_spec, plan_upsert
from newsrisk.plans.extract import extract
from newsrisk.plans.incremental import read_daily
from newsrisk.plans.publish import build_marts, write_table
from newsrisk.session import configure
from newsrisk.sources.articles import FORMATS, read_articles, read_day
from newsrisk.sources.bronze import ingest, read_bronze


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="newsrisk")
    steps = parser.add_subparsers(dest="step", required=True)

    get = steps.add_parser("extract", help="archived pages and sitemaps to article files")
    get.add_argument("--pages", help="Parquet: source, category, layout, html[, fetched_on]")
    get.add_argument("--sitemaps", help="Parquet: source, category, xml")
    get.add_argument("--date", required=True, type=dt.date.fromisoformat, help="wanted day")
    get.add_argument("--as-of", type=dt.date.fromisoformat, help="day of fetching")
    get.add_argument("--landing", required=True)
    get.add_argument("--rejects", required=True)

    check = steps.add_parser("check", help="quality checks; fails when one does")
    check.add_argument("--bronze")
    check.add_argument("--marts")

    load = steps.add_parser("load", help="article files to bronze")
    load.add_argument("--landing", required=True, help="folder with the article files")
    load.add_argument("--bronze", required=True)
    load.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="run date")
    load.add_argument("--format", choices=FORMATS, default="lines", help="of the article files")
    which = load.add_mutually_exclusive_group()
    which.add_argument("--date", help="load this day (default: the day before the run date)")
    which.add_argument("--all", action="store_true", help="load every file, recursively")

    build = steps.add_parser("build", help="bronze to marts")
    build.add_argument("--bronze", required=True)
    build.add_argument("--marts", required=True)
    build.add_argument("--incremental", action="store_true")

    export = steps.add_parser("plan-export", help="what an upsert into a target would do")
    export.add_argument("--marts", required=True)
    export.add_argument("--mart", choices=sorted(EXPORTS), default="daily")
    export.add_argument("--target", required=True, help="current target as Parquet")
    export.add_argument("--output", required=True)
    return parser.parse_args(argv)


def run_checks(spark: SparkSession, bronze: str | None, marts: str | None) -> None:
    """Print the failing rows of each check and exit with 1 when there are any."""
    reports = {}
    if bronze:
        reports["bronze"] = article_checks(read_bronze(spark, bronze), required=("title", "link", "source"))
    if marts:
        reports["daily"] = daily_checks(read_daily(spark, f"{marts}/daily"))
    failed = 0
    for table, report in reports.items():
        for r in report.collect():
            print(f"{table} {r.check} {r.column}: {r.failing_rows} failing")
            failed += not r.passed
    if failed:
        raise SystemExit(1)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = configure(SparkSession.builder.appName(f"newsrisk-{args.step}")).getOrCreate()
    if args.step == "load":
        if args.all:
            batch = read_articles(spark, args.landing, args.as_of, args.format)
        else:
            batch = read_day(spark, args.landing, args.date, args.as_of, args.format)
        ingest(spark, batch, args.bronze, cache=not args.all)
    elif args.step == "extract":
        table = lambda path: spark.read.parquet(path) if path else None
        extract(spark, args.date, args.landing, args.rejects, table(args.pages), table(args.sitemaps), args.as_of)
    elif args.step == "check":
        run_checks(spark, args.bronze, args.marts)
    elif args.step == "build":
        build_marts(spark, read_bronze(spark, args.bronze), args.marts, args.incremental)
    else:
        mart = read_daily(spark, f"{args.marts}/{args.mart}")
        target = spark.read.parquet(args.target)
        write_table(plan_upsert(mart, target, export_spec(args.mart)), args.output)


if __name__ == "__main__":
    main()
