"""Weights, goals and the two on-track rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv

# The rounding is decimal, half away from zero. A double beyond this has no places to round.
NUMERIC = "decimal(38,12)"


def round2(c: Column) -> Column:
    """Two decimals by decimal (not binary) rounding; a double again afterwards.

    What no decimal holds (1e26 and more, infinities, NaN) stays as it is.
    """
    return F.coalesce(F.round(c.try_cast(NUMERIC), 2).cast("double"), c.cast("double"))


def safe_div(x: Column, d: Column) -> Column:
    return x / F.nullif(d, F.lit(0))


def expected_loss(start: Column, goal: Column, duration: Column, days: Column) -> Column:
    """Planned loss to date: linear over the target duration, nothing before the start day."""
    return safe_div(start - goal, duration) * F.greatest(F.lit(0), days)


def actual_loss(start: Column, current: Column) -> Column:
    return start - current


def track_status(
    start: Column, goal: Column, duration: Column, start_day: Column, current: Column, days: Column
) -> Column:
    incomplete = (
        current.isNull()
        | start.isNull()
        | goal.isNull()
        | duration.isNull()
        | (duration <= 0)
        | start_day.isNull()
    )
    ahead = actual_loss(start, current) >= expected_loss(start, goal, duration, days)
    return (
        F.when(incomplete, fv.DATA_INCOMPLETE)
        .when(start <= goal, fv.GOAL_ACHIEVED)
        .when(ahead, fv.ON_TRACK)
        .otherwise(fv.OFF_TRACK)
    )


def goals_set(start: Column, goal: Column) -> Column:
    return start.isNotNull() & goal.isNotNull()


def onboarded(start: Column, goal: Column, has_fat: Column, has_food: Column) -> Column:
    return F.when(goals_set(start, goal) & has_fat & has_food, fv.YES).otherwise(fv.NO)


def progress_status(
    start: Column, goal: Column, current: Column, reported_loss: Column, dose_day: Column, as_of: Column
) -> Column:
    """On/off track against a 90-day target counted from the first dose."""
    target = start - goal
    ideal = target / F.lit(fv.PROGRESS_TARGET_DAYS) * F.greatest(F.datediff(as_of, dose_day), F.lit(0))
    loss = F.coalesce(actual_loss(start, current), reported_loss)
    return (
        F.when(target.isNull() | (target <= 0) | dose_day.isNull() | loss.isNull(), fv.DATA_INCOMPLETE)
        .when((loss >= ideal) & ~F.isnan(loss), fv.ON_TRACK)
        .otherwise(fv.OFF_TRACK)
    )


def active_strict(food: Column, habit: Column, activity: Column) -> Column:
    return food & habit & activity


def active_streak(food: Column, activity: Column) -> Column:
    return food & activity
