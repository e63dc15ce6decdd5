"""Unions, generators and sorts."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import ReportContext
from ..functions.dates import day
from .filters import active_cohort, done_appointments
from .joins import chat_message_join


def concat_rows(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def interactions(ctx: ReportContext) -> DataFrame:
    """Every contact between a patient and a consultant, one row each."""
    notes = ctx.role("patientnotes").filter("consultant_id IS NOT NULL")
    messages = chat_message_join(ctx.role("chats"), ctx.role("messages"))
    branches = [
        (notes, "date"),
        (done_appointments(ctx.role("appointment")), "date"),
        (messages, "messaged_at"),
    ]
    return concat_rows(
        *[df.select("patient_id", F.to_date(c).alias("interaction_date")) for df, c in branches]
    )


ACTIVITY_ROLES = ("activity", "patientfoodlogs", "metrics")


def activity_rows(ctx: ReportContext, cond: Column | None = None) -> DataFrame:
    frames = []
    for role in ACTIVITY_ROLES:
        rows = ctx.facts(role) if cond is None else ctx.facts(role).filter(cond)
        frames.append(rows.select("patient_id", F.to_date("date").alias("activity_date")))
    return concat_rows(*frames)


def activity_days(ctx: ReportContext, cond: Column | None = None) -> DataFrame:
    """Distinct days on which a patient logged anything."""
    return activity_rows(ctx, cond).distinct()


#: Days in one word of a day set.
WORD_DAYS = 64


def day_word(day_col: Column, first: dt.date) -> Column:
    """Which word of a patient's day set holds ``day_col`` (days from ``first`` on, 64 a word); NULL before."""
    offset = F.datediff(day_col, day(first))
    return F.when(offset >= 0, F.floor(offset / WORD_DAYS).cast("int"))


def day_bit(day_col: Column, first: dt.date) -> Column:
    """The bit of ``day_col`` within its word; NULL before ``first``."""
    offset = F.datediff(day_col, day(first))
    return F.when(offset >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(offset, F.lit(WORD_DAYS)).cast("int")))


def count_day_sets(rows: DataFrame, keys: list[str], others: dict[str, Column] | None = None) -> DataFrame:
    """Rows with ``day_word`` and ``day_bit`` to the number of distinct days per key, as ``active_days``.

    Two hash aggregations of fixed-width buffers, both combined on the map side: the words by
    ``bit_or`` per (key, word), then their ``bit_count`` summed per key.  No day is compared with
    another and no set of days is built, and days any number of words after the first still count.
    ``others`` are aggregates carried through both levels (their own kind each: max of max).
    """
    others = others or {}
    words = rows.groupBy(*keys, "day_word").agg(
        F.bit_or("day_bit").alias("day_bits"), *[c.alias(n) for n, c in others.items()]
    )
    return words.groupBy(*keys).agg(
        F.sum(F.bit_count("day_bits")).alias("active_days"), *[F.max(n).alias(n) for n in others]
    )


def active_days(ctx: ReportContext, n: int = 7) -> DataFrame:
    """Number of days with any log since ``as_of - n``; the window is open above, as in the reference."""
    first = ctx.days_back(n)
    dated = activity_rows(ctx, F.col("date") >= day(first)).select(
        "patient_id",
        day_word(F.col("activity_date"), first).alias("day_word"),
        day_bit(F.col("activity_date"), first).alias("day_bit"),
    )
    return count_day_sets(dated, ["patient_id"])


def all_cohorts(ctx: ReportContext) -> DataFrame:
    """Both cohorts.  Their plan types exclude each other, so one filter replaces the union."""
    return active_cohort(ctx)


def spine_start(ctx: ReportContext) -> dt.date:
    return min(ctx.streak_start, ctx.yesterday - dt.timedelta(days=30))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    return spark.range(1).select(F.explode(F.sequence(day(start), day(end))).alias("check_date"))


def sorted_report(df: DataFrame, keys: list[str], drop: tuple[str, ...] = ()) -> DataFrame:
    """Ascending with NULLs last; sort keys named in ``drop`` are not shown.

    Reports end their keys with an id: rows with equal names keep a fixed order, and
    the range partitioning behind the sort can split them.
    """
    return df.orderBy(*[F.col(f"`{k}`").asc_nulls_last() for k in keys]).drop(*drop)
