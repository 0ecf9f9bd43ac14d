"""The jobs, for spark-submit: python -m clickstrata JOB ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from clickstrata.operators.reports import REPORTS
from clickstrata.operators.silver import to_silver
from clickstrata.plans import gold_sql, report_sql
from clickstrata.plans.build_gold import build_gold
from clickstrata.schemas import DEFAULT_CUTOFF_YEAR, NEWEST_FILES, READY_FILES
from clickstrata.session import configure
from clickstrata.sources import bronze, catalog, gold_store, lake
from clickstrata.streaming.hours import DELAY, run_hours
from clickstrata.streaming.ingest import run_ingest
from clickstrata.streaming.refresh import approximate_activity, run_compaction, run_refresh


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickstrata", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    ready = jobs.add_parser("ready", help="count the files of the feed; say if they are enough")
    ready.add_argument("--feed", required=True)
    ready.add_argument("--files", type=int, default=READY_FILES)

    newest = jobs.add_parser("newest", help="list the files written last")
    newest.add_argument("--feed", required=True)
    newest.add_argument("--files", type=int, default=NEWEST_FILES)

    ingest = jobs.add_parser("ingest", help="take in new files of the feed")
    ingest.add_argument("--feed", required=True)
    ingest.add_argument("--lake", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument(
        "--cutoff", default=DEFAULT_CUTOFF_YEAR, help="first arrival year; empty for all files"
    )
    ingest.add_argument("--files-per-batch", type=int)
    ingest.add_argument("--database", help="database whose lake table gets the new batches")
    ingest.add_argument("--archive", help="folder outside the feed that finished files are moved to")

    clean = jobs.add_parser("clean", help="clean a registered table of lines, in one batch")
    clean.add_argument("--table", default="bronze.events_lines")
    clean.add_argument("--cutoff", default=DEFAULT_CUTOFF_YEAR)
    clean.add_argument("--into", required=True, help="folder that clean events are added to")

    hours = jobs.add_parser("hours", help="take in new files as a stream of hourly revenue")
    hours.add_argument("--feed", required=True)
    hours.add_argument("--into", required=True)
    hours.add_argument("--checkpoint", required=True)
    hours.add_argument("--delay", default=DELAY, help="how late arrivals may be")
    hours.add_argument("--cutoff", default=DEFAULT_CUTOFF_YEAR)

    refresh = jobs.add_parser("refresh", help="add what new batches hold to the gold tables")
    refresh.add_argument("--lake", required=True)
    refresh.add_argument("--gold", required=True)
    refresh.add_argument("--checkpoint", required=True)
    refresh.add_argument("--database", help="database whose gold tables are switched")
    refresh.add_argument("--sketches", action="store_true", help="keep sketches of users as well")

    activity = jobs.add_parser("activity", help="about how many users periods had, from sketches")
    activity.add_argument("--gold", required=True)
    activity.add_argument("--checkpoint", required=True)
    activity.add_argument("--period", default="month", choices=["week", "month", "quarter", "year"])

    rebuild = jobs.add_parser("rebuild", help="recompute all gold tables")
    silver = rebuild.add_mutually_exclusive_group(required=True)
    silver.add_argument("--lake")
    silver.add_argument("--compacted", help="folder of compacted silver")
    silver.add_argument("--table", help="registered table or view of silver")
    rebuild.add_argument("--gold", required=True)
    rebuild.add_argument("--database", help="database whose gold tables are switched")

    by_sql = jobs.add_parser("build-sql", help="make the gold tables by SQL in the catalog")
    by_sql.add_argument("--events", default="silver.events", help="registered table or view of silver")
    by_sql.add_argument("--database", default="gold")
    by_sql.add_argument("--refill", action="store_true", help="replace the rows of tables already there")

    compact = jobs.add_parser("compact", help="rewrite days with new events as few large files")
    compact.add_argument("--lake", required=True)
    compact.add_argument("--into", required=True)
    compact.add_argument("--checkpoint", required=True)

    register = jobs.add_parser("register", help="create databases, tables and views")
    register.add_argument("--feed")
    register.add_argument("--lake")
    register.add_argument("--compacted")
    register.add_argument("--gold")
    for layer in catalog.LAYERS:
        register.add_argument(f"--{layer}-database", default=layer)

    report = jobs.add_parser("report", help="show or save a report")
    report.add_argument("name", choices=REPORTS)
    source = report.add_mutually_exclusive_group(required=True)
    source.add_argument("--gold", help="folder of the gold tables")
    source.add_argument("--database", help="database of the gold tables; runs the SQL form")
    report.add_argument("--into")
    report.add_argument("--format", default="csv", choices=["csv", "parquet"])
    return parser


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    configure(spark)
    match args.job:
        case "ready":
            state = bronze.readiness(bronze.listing(spark, args.feed), args.files).first()
            print(f"{state.files} files, {state.bytes} bytes, newest {state.newest_arrival}: "
                  f"{'ready' if state.ready else 'not ready'}")
        case "newest":
            files = bronze.newest_files(bronze.listing(spark, args.feed), args.files)
            files.show(args.files, truncate=False)
        case "clean":
            lines = bronze.table_lines(spark, args.table, args.cutoff or None)
            events = to_silver(bronze.well_formed(bronze.parsed(lines)))
            print(f"{lake.write_silver(events, args.into)} events")
        case "hours":
            found = run_hours(
                spark, args.feed, args.into, args.checkpoint, args.delay, args.cutoff or None
            )
            print(f"{found.closed} hours closed, {found.too_late} purchases too late")
        case "activity":
            found = approximate_activity(spark, args.gold, args.checkpoint, args.period)
            found.orderBy("period").show(1000, truncate=False)
        case "build-sql":
            catalog.create_databases(spark, (args.database,))
            for name in gold_sql.SELECTS:
                gold_sql.create_table(spark, name, args.events, args.database)
                if args.refill:
                    gold_sql.refill_table(spark, name, args.events, args.database)
        case "ingest":
            result = run_ingest(
                spark,
                args.feed,
                args.lake,
                args.checkpoint,
                args.cutoff or None,
                args.files_per_batch,
                args.database,
                args.archive,
            )
            print(f"{result.lines} lines read, {result.accepted} accepted, {result.refused} refused"
                  if result.lines else "no new data")
        case "refresh":
            counts = run_refresh(
                spark, args.lake, args.gold, args.checkpoint, args.database, args.sketches
            )
            print(counts or "no new data")
        case "rebuild":
            if args.table:
                silver = spark.table(args.table)
            elif args.lake:
                silver = lake.read_silver(spark, args.lake)
            else:
                silver = lake.read_silver_files(spark, args.compacted)
            print(build_gold(silver, args.gold, args.database) or "no data")
        case "compact":
            if not run_compaction(spark, args.lake, args.into, args.checkpoint):
                print("no new data")
        case "register":
            databases = (args.bronze_database, args.silver_database, args.gold_database)
            catalog.create_databases(spark, databases)
            if args.feed:
                catalog.register_bronze(spark, args.feed, args.bronze_database)
            if args.lake:
                catalog.register_silver(spark, args.lake, args.silver_database)
            if args.compacted:
                catalog.register_compacted(spark, args.compacted, args.silver_database)
            if args.gold:
                catalog.register_gold(spark, args.gold, args.gold_database)
        case "report":
            if args.database:
                report = report_sql.over_catalog(spark, args.name, args.database)
            else:
                table, build = REPORTS[args.name]
                report = build(gold_store.read_table(spark, table, args.gold))
            if args.into:
                gold_store.write_report(report, args.into, args.format)
            else:
                report.show(max(1, report.count()), truncate=False)


if __name__ == "__main__":
    run(SparkSession.builder.appName("clickstrata").getOrCreate())
