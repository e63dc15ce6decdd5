"""User analytics: summary, per-cohort user tables, full table, annotation and actions.

Builders work on snake_case columns; ``titled`` puts on the display headings last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..context import ReportContext
from ..functions.dates import day, day_diff, latest_of, parse_date_multi
from ..functions.measures import (
    actual_loss,
    expected_loss,
    goals_set,
    progress_status,
    round2,
)
from ..functions.rules import class_map
from ..functions.text import is_no, reason_override, trim_alias, yes_no
from ..operators.aggregates import action_items, consultant_actions, recount, summary_delta, summary_matrix
from ..operators.joins import (
    join_features,
    last_per_name,
    lookup_join,
    sheet_lookup,
)
from ..operators.sets import sorted_report
from .features import (
    since,
    stored_wide,
    summary_features,
    today_columns,
    wide,
)


def titled(df: DataFrame, headings: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(heading) for c, heading in headings.items()])


# --- summary ------------------------------------------------------------------


def summary_table(ctx: ReportContext) -> DataFrame:
    return summary_delta(summary_matrix(summary_features(ctx)))


def report_summary_comparison(ctx: ReportContext) -> DataFrame:
    return titled(sorted_report(summary_table(ctx), ["sort_order"]), fv.SUMMARY_HEADINGS)


# --- per-cohort user tables ---------------------------------------------------


def user_flags(ctx: ReportContext, plan_type: str | None = None, active: bool = False) -> DataFrame:
    """One row per active patient with what is asked of them; ``track`` still holds the goal weight."""
    rows = _of_plan(wide(ctx, ("engagement", "consultant"), active=active), plan_type)
    return flag_columns(ctx, rows, *(["last_active_day"] if active else []))


def _of_plan(rows: DataFrame, plan_type: str | None) -> DataFrame:
    return rows if plan_type is None else rows.filter(F.col("cohort") == plan_type)


def flag_columns(ctx: ReportContext, rows: DataFrame, *more: str) -> DataFrame:
    """Of wide rows what the user tables show, and the columns in ``more``."""
    columns = today_columns(ctx)
    return rows.select(
        "patient_id",
        "cohort",
        trim_alias(F.col("firstname"), "patient_name"),
        F.col("nutritionist_id").alias("consultant_id"),
        "consultant_name",
        "plan_name",
        round2(F.col("goal_weight")).alias("track"),
        *[columns[c].alias(c) for c in ("user_onboarded", "days_since_contact", "meal_log", "weight_log")],
        *more,
    )


USER_PARTS = ("engagement", "consultant", "active_days", "side_effects")


def user_table(ctx: ReportContext, plan_type: str | None = None) -> DataFrame:
    """The flags with side effects and active days."""
    rows = _of_plan(wide(ctx, USER_PARTS, active=True), plan_type)
    joined = flag_columns(ctx, rows, "last_active_day", "side_effects", "active_days")
    filled = {
        "side_effects": F.coalesce("side_effects", F.lit(fv.NONE_TEXT)),
        "active_days": F.coalesce("active_days", F.lit(0)),
    }
    return joined.withColumns(filled).select("patient_id", "cohort", *fv.USER_HEADINGS)


def report_coach_app_users(ctx: ReportContext) -> DataFrame:
    return titled(user_table(ctx, fv.COACH_APP), fv.USER_HEADINGS)


def report_glp_users(ctx: ReportContext) -> DataFrame:
    return titled(user_table(ctx, fv.GLP), fv.USER_HEADINGS)


# --- full analytics -----------------------------------------------------------


def progress_inputs(ctx: ReportContext) -> DataFrame:
    """The weight columns of the full table, without its other joins."""
    start, current = F.col("start_weight"), F.col("current_weight")
    return wide(ctx, ("weights",)).select(
        "patient_id",
        "cohort",
        F.trim("firstname").alias("patient_name"),
        round2(start).alias("start_weight"),
        round2(F.col("goal_weight")).alias("goal_weight"),
        "current_weight",
        round2(actual_loss(start, current)).alias("actual_loss"),
    )


def full_table(ctx: ReportContext) -> DataFrame:
    joined = wide(ctx, ("engagement", "weights", "notes", "active_days"), active=True)
    start, goal, current = F.col("start_weight"), F.col("goal_weight"), F.col("current_weight")
    days = day_diff(day(ctx.as_of), F.col("start_day"))
    contact = latest_of(F.to_date("last_note_date"), F.col("last_visit_day"), F.col("last_message_day"))
    return joined.select(
        "patient_id",
        trim_alias(F.col("firstname"), "patient_name"),
        F.col("cohort").alias("plan_type"),
        yes_no(goals_set(start, goal)).alias("goals_set"),
        yes_no(F.col("has_fat")).alias("scale_logged"),
        yes_no(F.col("has_food")).alias("meal_logged"),
        today_columns(ctx)["user_onboarded"].alias("user_onboarded"),
        F.col("start_day").alias("start_date"),
        days.alias("days_since_start"),
        round2(start).alias("start_weight"),
        round2(goal).alias("goal_weight"),
        "current_weight",
        round2(expected_loss(start, goal, F.col("target_duration"), days)).alias("expected_loss"),
        round2(actual_loss(start, current)).alias("actual_loss"),
        "last_note_date",
        "last_note",
        day_diff(day(ctx.as_of), contact).alias("days_since_contact"),
        "last_meal_day",
        "last_weight_day",
        since("last_meal_day", ctx.days_back(3)).alias("meal_log"),
        since("last_weight_day", ctx.days_back(7)).alias("weight_log"),
        F.coalesce("active_days", F.lit(0)).alias("active_days"),
        "last_active_day",
    )


def report_full_analytics(ctx: ReportContext) -> DataFrame:
    rows = sorted_report(full_table(ctx), ["plan_type", "patient_name", "patient_id"])
    return titled(rows, fv.FULL_HEADINGS)


# --- annotation with the sheet ------------------------------------------------


def analytics_lookup(full: DataFrame) -> DataFrame:
    """Weights by patient name; of equal names the last in report order counts."""
    return last_per_name(full, "patient_name", list(PROGRESS_INPUTS), F.struct("cohort", "patient_name", "patient_id"))


def sheet_entries(sheet: DataFrame) -> DataFrame:
    """Sheet by name, its dose text parsed once per name, below the join."""
    entries = sheet_lookup(sheet).withColumn("dose_day", parse_date_multi(F.col("glp_1st_dose")))
    return entries.drop("glp_1st_dose")


PROGRESS_INPUTS = ("start_weight", "goal_weight", "current_weight", "actual_loss")


def progress_column(ctx: ReportContext) -> Column:
    return progress_status(*[F.col(c) for c in PROGRESS_INPUTS], F.col("dose_day"), day(ctx.as_of))


def progress_by_name(full: DataFrame, sheet: DataFrame, ctx: ReportContext) -> DataFrame:
    """Track status and sheet reasons by patient name."""
    joined = analytics_lookup(full).join(sheet_entries(sheet), "name_key", "left")
    return joined.select("name_key", progress_column(ctx).alias("progress"), *SHEET_REASONS.values())


def join_progress(users: DataFrame, full: DataFrame, sheet: DataFrame, ctx: ReportContext) -> DataFrame:
    """Users with ``progress`` and the sheet's reasons.

    By name, both lookups are joined to each other first (one row per name on either
    side), so the users meet them in a single join whose other side is unique per name.
    By id, each patient keeps the weights of their own and only the sheet goes by name.
    """
    if ctx.progress_key == "name":
        return lookup_join(users, "patient_name", progress_by_name(full, sheet, ctx))
    own = full.select("patient_id", *PROGRESS_INPUTS)
    joined = lookup_join(join_features(users, [own]), "patient_name", sheet_entries(sheet))
    return joined.withColumn("progress", progress_column(ctx)).drop(*PROGRESS_INPUTS, "dose_day")


# Report column -> sheet column whose text replaces a "No".
SHEET_REASONS = {
    "user_onboarded": "not_onboarding_reason",
    "meal_log": "meal_logging_reason",
    "weight_log": "weight_logging_reason",
}


def with_reasons(users: DataFrame) -> DataFrame:
    """Rows that carry the sheet's reasons: each replaces a "No" and marks the cell."""
    marked = {
        fv.USER_HEADINGS[c]: F.when(is_no(F.col(c)) & (F.col(reason) != ""), fv.CELL_REASON)
        for c, reason in SHEET_REASONS.items()
    }
    replaced = {c: reason_override(F.col(c), F.col(reason)) for c, reason in SHEET_REASONS.items()}
    return users.withColumns({"cell_classes": class_map(marked), **replaced}).drop(*SHEET_REASONS.values())


def annotate(users: DataFrame, full: DataFrame, sheet: DataFrame, ctx: ReportContext) -> DataFrame:
    """Track status and the sheet's reasons in place of the raw flags."""
    joined = with_reasons(join_progress(users, full, sheet, ctx))
    track = F.coalesce("progress", F.lit(fv.DATA_INCOMPLETE))
    return joined.withColumn("track", track).select(*users.columns, "cell_classes")


def annotated_table(ctx: ReportContext) -> DataFrame:
    return ctx.shared(
        "annotated", lambda: annotate(user_table(ctx), progress_inputs(ctx), ctx.role("sheet"), ctx)
    )


def annotated_track(ctx: ReportContext) -> DataFrame:
    """Cohort and track status of the annotated users, without the joins their other columns need."""

    def build() -> DataFrame:
        rows = wide(ctx, ())
        users = rows.select("patient_id", "cohort", trim_alias(F.col("firstname"), "patient_name"))
        joined = join_progress(users, progress_inputs(ctx), ctx.role("sheet"), ctx)
        track = F.coalesce("progress", F.lit(fv.DATA_INCOMPLETE)).alias("track")
        return joined.select("patient_id", "cohort", track)

    return ctx.shared("annotated", build)


def annotated_flags(ctx: ReportContext) -> DataFrame:
    """The flags of the annotated users with the sheet's reasons, likewise without other joins."""

    def build() -> DataFrame:
        reasons = sheet_lookup(ctx.role("sheet")).select("name_key", *SHEET_REASONS.values())
        return with_reasons(lookup_join(user_flags(ctx), "patient_name", reasons))

    return ctx.shared("annotated", build)


def report_annotated_users(ctx: ReportContext, plan_type: str | None = None) -> DataFrame:
    """The user tables as published, with ``__cell_classes__`` telling which cells were replaced."""
    users = _of_plan(annotated_table(ctx), plan_type)
    return titled(users, {**fv.USER_HEADINGS, "cell_classes": "__cell_classes__"})


def report_summary_final(ctx: ReportContext) -> DataFrame:
    """The summary and the annotated track meet one wide frame, written once, so patients are scanned once."""
    ctx = stored_wide(ctx, ("engagement", "weights"), prev=True)
    final = recount(summary_table(ctx), annotated_track(ctx))
    return titled(sorted_report(final, ["sort_order"]), fv.SUMMARY_HEADINGS)


def report_action_items(ctx: ReportContext) -> DataFrame:
    """One row per consultant, action and patient, in report order."""
    order = ["consultant", "action_order", "label", "patient_id"]
    return titled(sorted_report(action_items(annotated_flags(ctx)), order), fv.ACTION_ITEM_HEADINGS)


def report_actions_required(ctx: ReportContext) -> DataFrame:
    """The same with each list as one text."""
    actions = sorted_report(consultant_actions(annotated_flags(ctx)), ["consultant", "action_order"])
    return titled(actions, fv.ACTION_HEADINGS)
