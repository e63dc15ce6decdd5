"""Aggregations.  All of them combine on the map side; texts and structs are sorted there to do so."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.dates import between_days, lookback
from ..functions.text import is_no, signed
from ..functions.text import days_label as label_with_days


def present_since(df: DataFrame, c: str, as_of: dt.date, n: int, name: str) -> DataFrame:
    """'Yes' for every patient with a row on or after ``as_of - n`` days."""
    rows = df.filter(lookback(F.col(c), as_of, n))
    return rows.select("patient_id").distinct().withColumn(name, F.lit(fv.YES))


def logged_within(df: DataFrame, c: str, first: dt.date, last: dt.date, name: str) -> DataFrame:
    rows = df.filter(between_days(F.col(c), first, last))
    return rows.groupBy("patient_id").agg((F.count("*") > 0).alias(name))


def count_rows(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def counted_pieces(df: DataFrame, keys: list[str], c: str, sep: str) -> DataFrame:
    """Equal values counted (on the map side) and written out as ``sep + value`` that many times."""
    counted = df.filter(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count("*").alias("times"))
    return counted.withColumn("piece", F.repeat(F.concat(F.lit(sep), F.col(c)), F.col("times").cast("int")))


def without_first(joined: str, sep: str) -> Column:
    return F.substring(joined, len(sep) + 1, (1 << 31) - 1)


def agg_text(df: DataFrame, key: str, c: str, name: str, sep: str = ", ") -> DataFrame:
    """All values of ``c`` per key in one ordered text, duplicates kept.

    For values from a small vocabulary: however many rows a hot key has, the final
    row gathers one piece per distinct value.
    """
    joined = F.expr(f"listagg(piece, '') WITHIN GROUP (ORDER BY `{c}`)").alias("joined")
    texts = counted_pieces(df, [key], c, sep).groupBy(key).agg(joined)
    return texts.select(key, without_first("joined", sep).alias(name))


def long_text(df: DataFrame, keys: list[str], c: str, name: str, sep: str = ", ") -> DataFrame:
    """Like :func:`agg_text` for groups that may hold a large share of all rows.

    The values are range-partitioned, which splits a hot group over many tasks; each
    range is joined to one text where it lies, and only these texts meet in the
    final row.
    """
    ranged = counted_pieces(df, keys, c, sep).repartitionByRange(*keys, c)
    slices = (
        ranged.withColumn("slice", F.spark_partition_id())
        .groupBy(*keys, "slice")
        .agg(
            F.expr(f"listagg(piece, '') WITHIN GROUP (ORDER BY `{c}`)").alias("text"),
            F.min(c).alias("first_value"),
        )
    )
    joined = F.expr("listagg(text, '') WITHIN GROUP (ORDER BY first_value)").alias("joined")
    return slices.groupBy(*keys).agg(joined).select(*keys, without_first("joined", sep).alias(name))


def conditional_counts(df: DataFrame, group: list[str], conds: dict[str, str]) -> DataFrame:
    return df.groupBy(*group).agg(*[F.expr(f"count_if({c})").alias(n) for n, c in conds.items()])


def summary_conditions(suffix: str = "") -> dict[str, str]:
    """Report metrics in order: name -> SQL condition over a feature row of one day."""
    return {
        fv.METRIC_PAID: "true",
        fv.METRIC_NOT_ONBOARDED: f"user_onboarded{suffix} = '{fv.NO}'",
        fv.METRIC_ON_TRACK: f"track{suffix} = '{fv.ON_TRACK}'",
        fv.METRIC_OFF_TRACK: f"track{suffix} = '{fv.OFF_TRACK}'",
        fv.METRIC_NO_CONTACT: f"(days_since_contact{suffix} > 2 OR days_since_contact{suffix} IS NULL)",
        fv.METRIC_NO_MEAL: f"meal_log{suffix} = '{fv.NO}'",
        fv.METRIC_NO_WEIGHT: f"weight_log{suffix} = '{fv.NO}'",
    }


def summary_matrix(features: DataFrame) -> DataFrame:
    """7 metrics x (2 cohorts x 2 days) from one global aggregate of the cohort features.

    A missing cohort counts as zero because the aggregate has no grouping key.
    """
    today, prev = summary_conditions(), summary_conditions("_prev")
    rows = []
    for i, metric in enumerate(today, start=1):
        cells = {
            f"{short}_{day}": f"count_if(cohort = '{cohort}' AND {cond})"
            for short, cohort in (("coach", fv.COACH_APP), ("glp", fv.GLP))
            for day, cond in (("today", today[metric]), ("yesterday", f"in_prev AND {prev[metric]}"))
        }
        counts = ", ".join(f"'{name}', {count}" for name, count in cells.items())
        rows.append(f"named_struct('sort_order', {i}, 'metric', '{metric}', {counts})")
    return features.agg(F.expr(f"array({', '.join(rows)})").alias("rows")).select(F.inline("rows"))


def metric_rows(matrix: DataFrame) -> DataFrame:
    """The matrix with one count per row."""
    return matrix.unpivot(
        ["sort_order", "metric"],
        ["coach_today", "coach_yesterday", "glp_today", "glp_yesterday"],
        "cell",
        "n",
    )


def summary_delta(matrix: DataFrame) -> DataFrame:
    """``12 (+3)``: today's count and its change since yesterday."""

    def text(today: str, prev: str) -> Column:
        change = signed(F.col(today) - F.col(prev))
        return F.concat(F.col(today).cast("string"), F.lit(" ("), change, F.lit(")"))

    return matrix.select(
        "sort_order",
        "metric",
        text("coach_today", "coach_yesterday").alias("coach_app"),
        text("glp_today", "glp_yesterday").alias("glp"),
    )


def recount(summary: DataFrame, users: DataFrame) -> DataFrame:
    """Track rows of the summary replaced by plain counts of the annotated users.

    Whatever is not exactly on track counts as off track.  Nothing is replaced when
    either cohort is empty.
    """
    coach, glp = F.col("cohort") == fv.COACH_APP, F.col("cohort") == fv.GLP
    on = F.col("track") == fv.ON_TRACK
    off = ~F.coalesce(on, F.lit(False))
    counts = users.agg(
        F.count_if(coach & on).alias("coach_on"),
        F.count_if(coach & off).alias("coach_off"),
        F.count_if(glp & on).alias("glp_on"),
        F.count_if(glp & off).alias("glp_off"),
    ).filter("coach_on + coach_off > 0 AND glp_on + glp_off > 0")

    def row(metric: str, which: str) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            F.col(f"coach_{which}").cast("string").alias("coach_new"),
            F.col(f"glp_{which}").cast("string").alias("glp_new"),
        )

    replaced = counts.select(
        F.inline(F.array(row(fv.METRIC_ON_TRACK, "on"), row(fv.METRIC_OFF_TRACK, "off")))
    )
    return summary.join(replaced, "metric", "left").select(
        "sort_order",
        "metric",
        F.coalesce("coach_new", "coach_app").alias("coach_app"),
        F.coalesce("glp_new", "glp").alias("glp"),
    )


def action_items(users: DataFrame) -> DataFrame:
    """Long form: one row per consultant, action and patient to look after."""
    name = F.col("patient_name")
    actions = [
        (fv.ACTION_ONBOARDING, F.when(is_no(F.col("user_onboarded")), name)),
        (fv.ACTION_MEAL, F.when(is_no(F.col("meal_log")), name)),
        (fv.ACTION_WEIGHT, F.when(is_no(F.col("weight_log")), name)),
        (fv.ACTION_CONTACT, label_with_days(name, F.col("days_since_contact"))),
    ]
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("action_order"), F.lit(a).alias("action"), c.alias("label"))
            for i, (a, c) in enumerate(actions, start=1)
        ]
    )
    consultant = F.coalesce("consultant_name", F.lit(fv.UNKNOWN_CONSULTANT)).alias("consultant")
    ids = [c for c in ("patient_id",) if c in users.columns]
    return users.select(consultant, *ids, F.inline(F.filter(entries, lambda e: e["label"].isNotNull())))


def consultant_actions(users: DataFrame) -> DataFrame:
    """Per consultant and action the sorted patients as one text; empty lists do not appear.

    A list is one cell and so at most what a Spark string holds (2 GB); :func:`action_items`
    has no such limit and is what the flows publish.
    """
    return long_text(action_items(users), ["consultant", "action_order", "action"], "label", "patients")
