"""Per-patient features, one row per patient.

All log and contact tables meet in one union of narrow rows and one hash aggregation
by patient: a single shuffle, combined on the map side, whose buffers are plain dates
and booleans.  "A row since day d" is asked of the latest day instead of the rows, and
the yesterday variant is a second set of columns of the same pass, so neither costs
another scan.  Only "latest row" values (weight, note) and distinct active days need
frames of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..context import ReportContext
from ..functions.dates import day, day_diff, latest_of
from ..functions.measures import onboarded, track_status
from ..functions.text import yes_no
from ..operators.aggregates import agg_text
from ..operators.filters import active_cohort, done_appointments, severe_side_effects, started
from ..operators.joins import join_consultant, join_features, last_consultant_message
from ..operators.sets import ACTIVITY_ROLES, WORD_DAYS, active_days, count_day_sets
from ..operators.windows import latest_note, latest_weights
from ..sources.sinks import shared_folder, written_table


def engagement_rows(ctx: ReportContext, prev: bool, active: bool) -> DataFrame:
    """Narrow rows of all log and contact tables; a column is NULL where a table has no say.

    ``prev`` adds the columns as they stood yesterday, ``active`` the latest day with any log.
    """
    day_of, seen = "to_date(date)", "true"
    weight, fat = f"name = '{fv.BODY_WEIGHT}'", f"name = '{fv.BODY_FAT}'"
    named = "consultant_id IS NOT NULL"

    def when(cond: str, value: str = day_of) -> str:
        return f"CASE WHEN {cond} THEN {value} END"

    columns: dict[str, dict[str, str]] = {
        "patientfoodlogs": {"has_food": seen, "last_meal_day": day_of},
        "metrics": {"has_fat": when(fat, seen), "last_weight_day": when(weight)},
        "patientnotes": {"last_note_day": when(named)},
        "appointment": {"last_visit_day": day_of},
        "messages": {"last_message_day": "to_date(messaged_at)"},
    }
    if prev:
        earlier = f"date < DATE '{ctx.as_of}'"
        columns["patientfoodlogs"]["last_meal_day_prev"] = when(earlier)
        columns["metrics"]["last_fat_day_prev"] = when(f"{earlier} AND {fat}")
        columns["metrics"]["last_weight_day_prev"] = when(f"{earlier} AND {weight}")
        columns["patientnotes"]["last_note_day_prev"] = when(f"{earlier} AND {named}")
        columns["patientnotes"]["last_any_note_day_prev"] = when(earlier)
        columns["appointment"]["last_visit_day_prev"] = when(earlier)
        columns["messages"]["last_message_day_prev"] = when(
            f"messaged_at < DATE '{ctx.as_of}'", "to_date(messaged_at)"
        )
    if active:
        columns["activity"] = {}
        first = ctx.days_back(ACTIVE_WINDOW)
        offset = f"datediff({day_of}, DATE '{first}')"
        for role in ACTIVITY_ROLES:
            columns[role]["last_active_day"] = day_of
            columns[role]["day_word"] = when(f"{offset} >= 0", f"CAST(floor({offset} / {WORD_DAYS}) AS INT)")
            columns[role]["day_bit"] = when(f"{offset} >= 0", f"shiftleft(CAST(1 AS BIGINT), CAST(pmod({offset}, {WORD_DAYS}) AS INT))")

    def rows(role: str) -> DataFrame:
        if role == "messages":
            latest = {n: F.expr(f"max({c})") for n, c in columns[role].items()}
            return last_consultant_message(ctx.facts("chats"), ctx.role(role), latest)
        df = ctx.facts(role)
        if role == "metrics" and not active:
            df = df.filter(F.col("name").isin(fv.BODY_WEIGHT, fv.BODY_FAT))
        if role == "appointment":
            df = done_appointments(df)
        return df.selectExpr("patient_id", *[f"{c} AS {n}" for n, c in columns[role].items()])

    frames = [rows(role) for role in columns]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    return union


def engagement(ctx: ReportContext, prev: bool = False, active: bool = False) -> DataFrame:
    """Latest days per patient; with ``active`` also ``active_days``, from the same rows as day sets."""

    def build() -> DataFrame:
        rows = engagement_rows(ctx, prev, active)
        columns = [c for c in rows.columns if c not in ("patient_id", "day_word", "day_bit")]
        if not active:
            return rows.groupBy("patient_id").agg(*[F.max(c).alias(c) for c in columns])
        return count_day_sets(rows, ["patient_id"], {c: F.max(c) for c in columns})

    return ctx.shared("engagement", build)


def last_contact(prev_note: str | None = None) -> Column:
    """Latest contact day; with ``prev_note`` as it stood yesterday, counting that column's notes."""
    if prev_note is None:
        return latest_of(F.col("last_note_day"), F.col("last_visit_day"), F.col("last_message_day"))
    return latest_of(F.col(prev_note), F.col("last_visit_day_prev"), F.col("last_message_day_prev"))


def weights(ctx: ReportContext) -> DataFrame:
    return ctx.shared("weights", lambda: latest_weights(ctx.facts("metrics"), ctx.as_of))


#: Days back from the report day that count as active days (the window is open above).
ACTIVE_WINDOW = 7


def recent_active_days(ctx: ReportContext) -> DataFrame:
    return ctx.shared("active_days", lambda: active_days(ctx, ACTIVE_WINDOW))


def side_effect_texts(ctx: ReportContext) -> DataFrame:
    return ctx.shared(
        "side_effects", lambda: agg_text(severe_side_effects(ctx), "patient_id", "type", "side_effects")
    )


def notes(ctx: ReportContext) -> DataFrame:
    return ctx.shared("notes", lambda: latest_note(ctx.facts("patientnotes")))


def cohort_base(ctx: ReportContext, plan_type: str | None = None) -> DataFrame:
    return active_cohort(ctx, plan_type).select(
        F.col("id").alias("patient_id"),
        "firstname",
        "cohort",
        "plan_name",
        "nutritionist_id",
        "start_weight",
        "goal_weight",
        "target_duration",
        F.col("subscription_start_date").alias("start_day"),
        started(ctx.yesterday).alias("in_prev"),
    )


PARTS = ("engagement", "consultant", "weights", "notes", "active_days", "side_effects")


def wide(
    ctx: ReportContext, parts: tuple[str, ...] = PARTS, prev: bool = False, active: bool = False
) -> DataFrame:
    """One row per patient of the cohorts, with the parts that a report derives from.

    Every part is unique by patient and joined once.  Where a run has stored the frame
    (:func:`stored_wide`), it is read as it is, whatever parts are asked for.
    """

    def build() -> DataFrame:
        rows = cohort_base(ctx)
        if "consultant" in parts:
            rows = join_consultant(rows, ctx.role("consultants"))
        # With active, the engagement pass counts active days itself.
        separate = "active_days" in parts and not (active and "engagement" in parts)
        frames = {
            "engagement": lambda: engagement(ctx, prev, active),
            "weights": lambda: weights(ctx),
            "notes": lambda: notes(ctx),
            "active_days": lambda: recent_active_days(ctx),
            "side_effects": lambda: side_effect_texts(ctx),
        }
        wanted = [name for name in frames if name in parts and (name != "active_days" or separate)]
        return join_features(rows, [frames[name]() for name in wanted])

    return ctx.shared("wide", build)


def stored_wide(
    ctx: ReportContext, parts: tuple[str, ...] = PARTS, prev: bool = False, active: bool = False, folder: str | None = None
) -> ReportContext:
    """The context with its wide frame written once, for what meets it several times."""
    if ctx.holds("wide"):
        return ctx
    rows = wide(ctx, parts, prev, active)
    return ctx.pinned({"wide": written_table(rows, folder or shared_folder(ctx.spark), "wide")})


def since(last: str, first_day: dt.date) -> Column:
    return yes_no(F.col(last) >= day(first_day))


def today_columns(ctx: ReportContext) -> dict[str, Column]:
    """Columns over a cohort row joined with :func:`engagement`."""
    return {
        "user_onboarded": onboarded(
            F.col("start_weight"), F.col("goal_weight"), F.col("has_fat"), F.col("has_food")
        ),
        "days_since_contact": day_diff(day(ctx.as_of), last_contact()),
        "meal_log": since("last_meal_day", ctx.days_back(3)),
        "weight_log": since("last_weight_day", ctx.days_back(7)),
    }


def prev_columns(ctx: ReportContext) -> dict[str, Column]:
    contact = last_contact("last_note_day_prev")
    if ctx.coach_prev_any_note:
        any_note = last_contact("last_any_note_day_prev")
        contact = F.when(F.col("cohort") == fv.COACH_APP, any_note).otherwise(contact)
    return {
        "user_onboarded_prev": onboarded(
            F.col("start_weight"),
            F.col("goal_weight"),
            F.col("last_fat_day_prev").isNotNull(),
            F.col("last_meal_day_prev").isNotNull(),
        ),
        "days_since_contact_prev": day_diff(day(ctx.yesterday), contact),
        "meal_log_prev": since("last_meal_day_prev", ctx.days_back(4)),
        "weight_log_prev": since("last_weight_day_prev", ctx.days_back(8)),
    }


def status_column(on: Column, current: str) -> Column:
    return track_status(
        F.col("start_weight"),
        F.col("goal_weight"),
        F.col("target_duration"),
        F.col("start_day"),
        F.col(current),
        day_diff(on, F.col("start_day")),
    )


def summary_features(ctx: ReportContext) -> DataFrame:
    """Both cohorts with today's and yesterday's flags: all the summary counts from one frame."""
    joined = wide(ctx, ("engagement", "weights"), prev=True)
    columns = {
        **today_columns(ctx),
        **prev_columns(ctx),
        "track": status_column(day(ctx.as_of), "current_weight"),
        "track_prev": status_column(day(ctx.yesterday), "current_weight_prev"),
    }
    return joined.select("patient_id", "cohort", "in_prev", *[c.alias(n) for n, c in columns.items()])
