"""Daily jobs for spark-submit.

    spark-submit --py-files cohortlane.zip cohortlane/jobs.py user_analytics \\
        --roles /data/roles --sheet /data/sheet.csv --as-of 2024-01-31 \\
        --nutritionists 2,4,6 --out /data/reports/2024-01-31
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from cohortlane.context import ReportContext
from cohortlane.plans.leads import run_lead_sync
from cohortlane.plans.registry import FLOWS, run_flow
from cohortlane.sources.roles import folder_reader
from cohortlane.sources.sheet import read_sheet, sheet_role


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Daily member and lead jobs")
    parser.add_argument("job", choices=[*FLOWS, "lead_sync"])
    parser.add_argument("--roles", required=True, help="folder of role tables (parquet)")
    parser.add_argument("--out", required=True, help="folder for the run's results")
    parser.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="the day taken as today")
    parser.add_argument("--sheet", help="sheet as CSV; without it the sheet role is read")
    parser.add_argument("--nutritionists", help="ids, comma-separated; without it patients of all are taken")
    parser.add_argument("--team-phones", help="phones, comma-separated; without it all patients are followed")
    parser.add_argument("--team-table", help="Parquet table with a phone column, for a long list")
    parser.add_argument("--team-leave-out", default="", help="names, comma-separated")
    parser.add_argument("--streak-start", type=dt.date.fromisoformat, default=dt.date(2024, 1, 1))
    parser.add_argument("--zone", default="Asia/Kolkata")
    parser.add_argument("--window-mode", choices=["literal", "local_day"], default="literal")
    parser.add_argument("--progress-key", choices=["name", "id"], default="name")
    parser.add_argument("--signups-table", help="table the lead flow appends its signups to")
    parser.add_argument("--lead-table", help="table lead_sync inserts into")
    args = parser.parse_args(argv)
    if args.team_phones is not None and args.team_table:
        parser.error("either --team-phones or --team-table")
    if args.job == "lead_sync" and not args.lead_table:
        parser.error("lead_sync needs --lead-table")
    return args


def listed(text: str) -> tuple[str, ...]:
    return tuple(part.strip() for part in text.split(",") if part.strip())


def make_context(spark: SparkSession, args: argparse.Namespace) -> ReportContext:
    read = folder_reader(spark, args.roles)
    if args.sheet:
        sheet, roles = sheet_role(read_sheet(spark, args.sheet)), read

        def read(role):
            return sheet if role == "sheet" else roles(role)

    team = None if args.team_phones is None else listed(args.team_phones)
    if args.team_table:
        team = spark.read.parquet(args.team_table).select("phone")
    return ReportContext(
        spark=spark,
        read=read,
        as_of=args.as_of,
        zone=args.zone,
        nutritionists=None if args.nutritionists is None else tuple(int(n) for n in listed(args.nutritionists)),
        team_phones=team,
        team_excluded_names=listed(args.team_leave_out),
        streak_start=args.streak_start,
        window_mode=args.window_mode,
        progress_key=args.progress_key,
    )


def run(spark: SparkSession, argv: list[str] | None = None) -> bool:
    """True when everything asked for was done."""
    args = arguments(argv)
    ctx = make_context(spark, args)
    if args.job == "lead_sync":
        stats = run_lead_sync(ctx, args.lead_table, args.out).stats.first()
        print(stats)
        return stats.success
    paths, failures = run_flow(ctx, args.job, args.out, args.signups_table)
    for heading, path in paths.items():
        print(f"{heading}: {path}")
    for heading, reason in failures.items():
        print(f"{heading} failed: {reason}")
    return not failures


if __name__ == "__main__":
    session = (
        SparkSession.builder.appName("cohortlane")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    raise SystemExit(0 if run(session) else 1)
