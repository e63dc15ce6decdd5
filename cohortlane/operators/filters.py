"""Cohort and row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..context import ReportContext
from ..functions.dates import before_day, day, lookback
from ..functions.phones import digits_only
from ..functions.text import non_blank, not_in_lowered
from .joins import join_subscription

COHORTS = (fv.COACH_APP, fv.GLP)


def member_plans(ctx: ReportContext) -> DataFrame:
    """Patients with the plan they are on."""
    return join_subscription(ctx.role("patients"), ctx.role("subscriptions"))


def active_cohort(
    ctx: ReportContext, plan_type: str | None = None, started_by: dt.date | None = None
) -> DataFrame:
    """Active patients of one plan type, or of both with ``cohort`` telling them apart.

    A subscription counts as running when it ends today or later, also in the
    yesterday variant (``started_by``).
    """
    members = member_plans(ctx).filter(
        F.col("is_active")
        & (F.col("status") == fv.ACTIVE_STATUS)
        & (F.col("subscription_end_date") >= day(ctx.as_of))
        & non_blank(F.col("firstname"))
        & (F.lit(True) if ctx.nutritionists is None else in_list(F.col("nutritionist_id"), ctx.nutritionists))
        & cohort_filter(ctx, plan_type)
    )
    if started_by is not None:
        members = members.filter(started(started_by))
    return members.withColumnRenamed("plan_type", "cohort")


def cohort_filter(ctx: ReportContext, plan_type: str | None = None) -> Column:
    coach = F.col("plan_type") == fv.COACH_APP
    glp = (F.col("plan_type") == fv.GLP) & not_in_lowered(F.col("plan_name"), ctx.excluded_glp_plans)
    return {None: coach | glp, fv.COACH_APP: coach, fv.GLP: glp}[plan_type]


def started(by: dt.date) -> Column:
    """Started on that day or before; a timestamp counts by its day."""
    return before_day(F.col("subscription_start_date"), by + dt.timedelta(days=1))


def in_list(c: Column, values: tuple) -> Column:
    return c.isin(*values)


def in_table(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Membership in a list too long for ``isin``: a semi join, broadcast only if Spark finds it small."""
    keys = listed.select(F.col(listed.columns[0]).alias(column)).distinct()
    return df.join(keys, column, "left_semi")


def severe_side_effects(ctx: ReportContext) -> DataFrame:
    """Patient-reported effects of the last seven days, the mild ones left out."""
    return ctx.facts("patientsideeffects").filter(
        (F.col("creator") == fv.REPORTED_BY_PATIENT)
        & lookback(F.col("date"), ctx.as_of, 7)
        & ~F.lower("type").isin(*fv.MILD_SIDE_EFFECTS)
    )


def body_weights(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("name") == fv.BODY_WEIGHT)


def body_fats(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("name") == fv.BODY_FAT)


def done_appointments(appointments: DataFrame) -> DataFrame:
    return appointments.filter(F.col("status") == fv.APPOINTMENT_DONE)


def with_reject_reason(signups: DataFrame) -> DataFrame:
    """Adds the lead phone (all digits) and, where it is too short, why the row is rejected."""
    phone = digits_only(F.col("phone"))
    return signups.withColumn("phone_number", phone).withColumn(
        "reject_reason",
        F.when(F.length("phone_number") < fv.MIN_PHONE_DIGITS, fv.REJECT_PHONE),
    )


def split_valid(signups: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = with_reject_reason(signups)
    return checked.filter("reject_reason IS NULL"), checked.filter("reject_reason IS NOT NULL")
