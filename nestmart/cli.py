"""Command line for ``spark-submit``: the daily job and its maintenance steps.

  spark-submit --py-files nestmart.zip nestmart/cli.py run-day --lake s3://lake --date 2024-01-01 --database dw
  python -m nestmart.cli process-landed --lake s3://lake --database dw
  python -m nestmart.cli dim-date --database dw
  python -m nestmart.cli restructure --database dw
  python -m nestmart.cli report --database dw --name genre --output s3://out/genre

The session comes from the launcher (``getOrCreate``); nothing here picks a
master. Scratch and stream checkpoints go under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from nestmart.session import ensure_checkpoint_dir


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="nestmart")
    sub = p.add_subparsers(dest="command", required=True)

    day = sub.add_parser("run-day", help="clean, model and publish one landed day")
    day.add_argument("--lake", required=True)
    day.add_argument("--date", required=True, help="YYYY-MM-DD")
    day.add_argument("--database", required=True)
    day.add_argument("--multi-line", action="store_true",
                     help="raw files hold one JSON array each (default: JSON-lines)")
    day.add_argument("--buckets", type=int, default=None)
    day.add_argument("--replace-day", action="store_true",
                     help="replace, not append, a stored metrics entry of this date")

    landed = sub.add_parser("process-landed", help="publish every day landed since last run")
    landed.add_argument("--lake", required=True)
    landed.add_argument("--database", required=True)
    landed.add_argument("--checkpoint", default=None)
    landed.add_argument("--multi-line", action="store_true")
    landed.add_argument("--buckets", type=int, default=None)

    cal = sub.add_parser("dim-date", help="create or replace the calendar table")
    cal.add_argument("--database", required=True)
    cal.add_argument("--start", default=None)
    cal.add_argument("--end", default=None)

    res = sub.add_parser("restructure", help="parallel metric arrays to one array of structs")
    res.add_argument("--database", required=True)
    res.add_argument("--table", default="movies")
    res.add_argument("--buckets", type=int, default=None)

    rep = sub.add_parser("report", help="write one report as Parquet")
    rep.add_argument("--database", required=True)
    rep.add_argument("--name", choices=["title", "genre", "cast"], required=True)
    rep.add_argument("--output", required=True)
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"nestmart-{args.command}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.command == "run-day":
        from nestmart.plans.job import run_day
        run_day(spark, args.lake, args.date, args.database, multi_line=args.multi_line,
                buckets=args.buckets, replace_day=args.replace_day)
    elif args.command == "process-landed":
        from nestmart.streaming.landing import process_landed_days
        process_landed_days(spark, args.lake, args.database, args.checkpoint,
                            multi_line=args.multi_line, buckets=args.buckets)
    elif args.command == "dim-date":
        from nestmart.plans import calendar
        calendar.create_dim_date_table(spark, args.database,
                                       args.start or calendar.DEFAULT_START,
                                       args.end or calendar.DEFAULT_END)
    elif args.command == "restructure":
        from nestmart.plans.restructure import restructure_table
        restructure_table(spark, args.database, args.table, buckets=args.buckets)
    elif args.command == "report":
        from nestmart.plans import reports
        from nestmart.sources.tables import qualified
        movies = spark.table(qualified(args.database, "movies"))
        if args.name == "title":
            out = reports.report_by_title(movies)
        elif args.name == "genre":
            out = reports.report_by_genre(movies)
        else:
            out = reports.report_by_cast(movies, spark.table(qualified(args.database, "credits")))
        out.write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
