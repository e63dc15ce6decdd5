"""Team streaks: who logged yesterday, for how many days in a row, and what is missing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..context import ReportContext
from ..functions.dates import between_days
from ..functions.measures import active_strict
from ..functions.text import inactivity_reason, not_in_normalised, short_name, yes_no
from ..operators.aggregates import logged_within
from ..operators.filters import body_weights, in_list, in_table
from ..operators.joins import join_features, logs_by_day
from ..operators.sets import sorted_report
from ..operators.windows import streak_marks
from .reports import titled

LOG_ROLES = {"food": "patientfoodlogs", "habit": "patienthabitlogs", "activity": "activity"}


def log_tables(ctx: ReportContext) -> dict[str, DataFrame]:
    return {name: ctx.facts(role) for name, role in LOG_ROLES.items()}


def team_targets(ctx: ReportContext) -> DataFrame:
    """The followed patients, found by phone, without the excluded names."""
    patients = ctx.role("patients")
    if ctx.team_phones is None:
        chosen = patients
    elif isinstance(ctx.team_phones, DataFrame):
        chosen = in_table(patients, "phone", ctx.team_phones)
    else:
        chosen = patients.filter(in_list(F.col("phone"), ctx.team_phones))
    named = chosen.select(
        F.col("id").alias("patient_id"), short_name(F.col("firstname"), F.col("lastname")).alias("name")
    )
    if not ctx.team_excluded_names:
        return named
    return named.filter(not_in_normalised(F.col("name"), ctx.team_excluded_names))


def daily_logs(ctx: ReportContext) -> DataFrame:
    """Days with at least one log, from the streak's start day up to yesterday.

    Days without any log need no row: they end a streak by being absent.
    """
    first = min(ctx.streak_start, ctx.yesterday)
    return logs_by_day(log_tables(ctx), between_days(F.col("date"), first, ctx.yesterday))


def weight_logged(ctx: ReportContext) -> DataFrame:
    first = ctx.yesterday - dt.timedelta(days=6)
    return logged_within(body_weights(ctx.facts("metrics")), "date", first, ctx.yesterday, "weight_logged")


def team_streaks(ctx: ReportContext) -> DataFrame:
    marks = streak_marks(daily_logs(ctx), ctx.yesterday, ctx.streak_start)
    joined = join_features(team_targets(ctx), [marks, weight_logged(ctx)])
    food, habit, activity = (F.coalesce(c, F.lit(False)) for c in LOG_ROLES)
    return joined.select(
        "patient_id",
        "name",
        yes_no(active_strict(food, habit, activity)).alias("active_yesterday"),
        F.coalesce("streak", F.lit(0)).alias("streak"),
        yes_no(F.col("weight_logged")).alias("weight_log"),
        inactivity_reason(food, habit, activity).alias("reason"),
    )


def report_team_streaks(ctx: ReportContext) -> DataFrame:
    return titled(sorted_report(team_streaks(ctx), ["name", "patient_id"]), fv.STREAK_HEADINGS)
