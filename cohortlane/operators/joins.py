"""Joins.

No join carries a broadcast hint.  Spark broadcasts a side when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise, so a
dimension or lookup that has grown is handled without a change here.  Looked-up sides
are unique per key, which lets the adaptive skew join split a hot key of the other side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day
from ..functions.phones import normalize_phone, spread_blank
from ..functions.text import normalize_name


def join_subscription(patients: DataFrame, subscriptions: DataFrame) -> DataFrame:
    plans = subscriptions.select(
        F.col("id").alias("active_subscription_id"),
        F.col("name").alias("plan_name"),
        F.col("type").alias("plan_type"),
    )
    return patients.join(plans, "active_subscription_id")


def join_consultant(patients: DataFrame, consultants: DataFrame) -> DataFrame:
    names = consultants.select(F.col("id").alias("nutritionist_id"), F.col("name").alias("consultant_name"))
    return patients.join(names, "nutritionist_id", "left")


def chat_message_join(chats: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages a chat's own consultant sent; the sender test is part of the join key."""
    own = chats.select(F.col("id").alias("chat_id"), "patient_id", F.col("consultant_id").alias("sender"))
    return own.join(messages, ["chat_id", "sender"])


def last_consultant_message(
    chats: DataFrame, messages: DataFrame, aggregates: dict[str, Column]
) -> DataFrame:
    """Per chat aggregates of the consultant's messages.

    Messages shrink to one row per chat and sender before they are shuffled, so a
    chat with a third of all messages costs no more than any other.
    """
    per_sender = messages.groupBy("chat_id", "sender").agg(*[c.alias(n) for n, c in aggregates.items()])
    return chat_message_join(chats, per_sender).select("patient_id", *aggregates)


def exists_flag(base: DataFrame, fact: DataFrame, key: str, name: str, cond: Column | None = None) -> DataFrame:
    """Whether ``fact`` has a row (meeting ``cond``) for the key."""
    rows = fact if cond is None else fact.filter(cond)
    present = rows.select(F.col("patient_id").alias(key)).distinct().withColumn(name, F.lit(True))
    return base.join(present, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def logs_by_day(facts: dict[str, DataFrame], cond: Column | None = None) -> DataFrame:
    """One row per patient and day with a flag per log table, from a single aggregation."""
    union = None
    for name, fact in facts.items():
        rows = fact if cond is None else fact.filter(cond)
        rows = rows.select("patient_id", F.to_date("date").alias("check_date"), F.lit(True).alias(name))
        union = rows if union is None else union.unionByName(rows, allowMissingColumns=True)
    flags = [F.coalesce(F.max(name), F.lit(False)).alias(name) for name in facts]
    return union.groupBy("patient_id", "check_date").agg(*flags)


def exists_by_day(spine: DataFrame, facts: dict[str, DataFrame], cond: Column | None = None) -> DataFrame:
    joined = spine.join(logs_by_day(facts, cond), ["patient_id", "check_date"], "left")
    return joined.select(
        "patient_id", "check_date", *[F.coalesce(name, F.lit(False)).alias(name) for name in facts]
    )


def cross_dates(base: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Every row of ``base`` for every day, by a generator (no join, no shuffle)."""
    return base.withColumn("check_date", F.explode(F.sequence(day(start), day(end))))


def join_features(base: DataFrame, features: list[DataFrame], key: str = "patient_id") -> DataFrame:
    """Star of left joins; each feature frame is unique by the key.

    Frames that were aggregated by the key in the same plan are partitioned by it already;
    frames read from files are not.
    """
    for feature in features:
        base = base.join(feature, key, "left")
    return base


def distinct_phones(df: DataFrame) -> DataFrame:
    """Comparison keys present in ``df``; blank ones never stand for a customer."""
    key = normalize_phone(F.col("phone")).alias("phone_key")
    return df.select(key).filter("phone_key <> ''").distinct()


def anti_join_phones(signups: DataFrame, active: DataFrame) -> DataFrame:
    """Signups whose phone is no active customer's; blank phones always stay."""
    keyed = signups.withColumn("phone_key", normalize_phone(F.col("phone"))).withColumn(
        "join_key", spread_blank(F.col("phone_key"), F.col("id"))
    )
    known = distinct_phones(active).withColumnRenamed("phone_key", "join_key")
    return keyed.join(known, "join_key", "left_anti").drop("join_key")


def last_per_name(df: DataFrame, name: str, values: list[str], order: Column) -> DataFrame:
    """One row per normalised name, the last by ``order``; rows without a name are skipped."""
    keyed = df.withColumn("name_key", normalize_name(F.col(name))).filter("name_key IS NOT NULL")
    packed = F.max_by(F.struct(*values), order).alias("last")
    return keyed.groupBy("name_key").agg(packed).select("name_key", "last.*")


def sheet_lookup(sheet: DataFrame) -> DataFrame:
    values = [c for c in sheet.columns if c not in ("row_no", "name")]
    return last_per_name(sheet, "name", values, F.col("row_no"))


def lookup_join(df: DataFrame, name: str, lookup: DataFrame) -> DataFrame:
    """Left join by normalised name.  Rows without a name match nothing and are spread over the tasks."""
    name_key = normalize_name(F.col(name))
    nowhere = F.concat(F.lit("\0"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))
    keyed = df.withColumn("join_key", F.coalesce(name_key, nowhere))
    return keyed.join(lookup.withColumnRenamed("name_key", "join_key"), "join_key", "left").drop("join_key")
