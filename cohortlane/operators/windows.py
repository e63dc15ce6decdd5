"""Latest row per patient, and streaks of consecutive days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import before_day, day
from ..functions.measures import active_streak, round2
from .filters import body_weights


def newest_first_key(*columns: str) -> Column:
    """Ordering under which a missing date counts as the newest, as in a descending SQL sort."""
    parts = []
    for c in columns:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.struct(*parts)


WEIGHT_ORDER = ("date", "created_at", "event_id")


def latest_weight(metrics: DataFrame, as_of: dt.date | None = None, name: str = "current_weight") -> DataFrame:
    """Latest body weight per patient; with ``as_of`` only facts before that day.

    ``max_by`` combines on the map side, so a patient with many rows sends one per task.
    """
    weights = body_weights(metrics)
    if as_of is not None:
        weights = weights.filter(before_day(F.col("date"), as_of))
    latest = F.max_by("value", newest_first_key(*WEIGHT_ORDER))
    return weights.groupBy("patient_id").agg(latest.alias("v")).select("patient_id", round2(F.col("v")).alias(name))


def latest_weights(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    """Today's and yesterday's latest weight from one scan."""
    key = newest_first_key(*WEIGHT_ORDER)
    return (
        body_weights(metrics)
        .groupBy("patient_id")
        .agg(
            F.max_by("value", key).alias("v"),
            F.max_by("value", F.when(before_day(F.col("date"), as_of), key)).alias("v_prev"),
        )
        .select(
            "patient_id",
            round2(F.col("v")).alias("current_weight"),
            round2(F.col("v_prev")).alias("current_weight_prev"),
        )
    )


def first_ranked(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Rank-1 row per key by a window (Spark limits each task's rows before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    return df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def latest_note(notes: DataFrame) -> DataFrame:
    """Latest note that names a consultant, with its text."""
    named = notes.filter("consultant_id IS NOT NULL")
    last = F.max_by(F.struct("date", "description"), newest_first_key("date", "id")).alias("last")
    return named.groupBy("patient_id").agg(last).select(
        "patient_id",
        F.col("last.date").cast("timestamp").alias("last_note_date"),
        F.col("last.description").alias("last_note"),
    )


def islands(df: DataFrame, key: str, day_column: str, flag: str) -> DataFrame:
    """Adds ``island``, equal for consecutive days on which ``flag`` has the same value."""
    w = Window.partitionBy(key, flag).orderBy(day_column)
    return df.withColumn("island", F.date_sub(day_column, F.row_number().over(w)))


#: Days in one word of a streak's day set.
WORD_DAYS = 64


def _trailing_ones(word: Column) -> Column:
    """Set bits of ``word`` below its lowest clear bit; only the word 2^63 - 1 overflows the + 1, and has 63."""
    return F.coalesce(F.bit_count(word.bitwiseXOR(F.try_add(word, F.lit(1).cast("long")))) - 1, F.lit(63))


def run_ending(active: Column, check_date: Column, first: dt.date, last: dt.date) -> tuple[list[Column], Column]:
    """Aggregates of day bits and the length of the run of active days that ends on ``last``.

    Days from ``last`` back to ``first`` are bits of ceil(days / 64) words, a number fixed when
    the plan is built; each word is one ``bit_or`` of a hash aggregation, so no window orders a
    patient's days and no set of days is built. The run is 64 for each full word from ``last``
    back, plus the trailing ones of the first word that is not full. Returns the aggregates
    (named ``streak_w<j>``) and, over their results, the length (NULL for none).
    """
    span = (last - first).days + 1
    count = max(1, -(-span // WORD_DAYS))
    inside = active & (check_date >= day(first)) & (check_date <= day(last))
    offset = F.datediff(day(last), check_date)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(offset, F.lit(WORD_DAYS)).cast("int"))
    word = F.floor(offset / WORD_DAYS)
    aggs = [F.bit_or(F.when(inside & (word == j), bit)).alias(f"streak_w{j}") for j in range(count)]
    length = F.lit(WORD_DAYS * count).cast("long")
    for j in reversed(range(count)):
        w = F.coalesce(F.col(f"streak_w{j}"), F.lit(0).cast("long"))
        length = F.when(w != -1, WORD_DAYS * j + _trailing_ones(w)).otherwise(length)
    return aggs, F.when(length > 0, length)


def streak_marks(days: DataFrame, as_of_prev: dt.date, start: dt.date) -> DataFrame:
    """Per patient the streak ending on ``as_of_prev`` and that day's log flags.

    ``days`` has one row per patient and day with at least one log.  One hash aggregation by
    patient holds the streak's day bits (:func:`run_ending`) and the day's flags.
    """
    active = active_streak(F.col("food"), F.col("activity"))
    aggs, length = run_ending(active, F.col("check_date"), start, as_of_prev)
    flags = [F.max(F.when(F.col("check_date") == day(as_of_prev), F.col(c))).alias(c) for c in ("food", "habit", "activity")]
    marks = days.groupBy("patient_id").agg(*aggs, *flags)
    return marks.select(
        "patient_id",
        length.cast("long").alias("streak"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("food", "habit", "activity")],
    )


def current_streak(active_days: DataFrame, last_day: dt.date, start: dt.date) -> DataFrame:
    """Length of the run of active days that ends on ``last_day``; patients without one do not appear."""
    aggs, length = run_ending(F.lit(True), F.col("check_date"), start, last_day)
    marks = active_days.groupBy("patient_id").agg(*aggs)
    return marks.select("patient_id", length.alias("streak")).filter(F.col("streak").isNotNull())
