"""Role tables: the fixed schema of every input the reports read."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "patient_id BIGINT, date TIMESTAMP"

ROLE_SCHEMAS = {
    "patients": (
        "id BIGINT, firstname STRING, middlename STRING, lastname STRING, phone STRING, email STRING, "
        "created_at TIMESTAMP, is_active BOOLEAN, status STRING, active_subscription_id INT, "
        "nutritionist_id BIGINT, start_weight DOUBLE, goal_weight DOUBLE, target_duration INT, "
        "subscription_start_date DATE, subscription_end_date DATE"
    ),
    "subscriptions": "id INT, name STRING, type STRING",
    "consultants": "id BIGINT, name STRING",
    "metrics": (
        "patient_id BIGINT, event_id BIGINT, name STRING, value DOUBLE, date TIMESTAMP, created_at TIMESTAMP"
    ),
    "patientfoodlogs": _LOG,
    "patienthabitlogs": _LOG,
    "activity": _LOG,
    "patientnotes": (
        "id BIGINT, patient_id BIGINT, consultant_id BIGINT, date TIMESTAMP, description STRING"
    ),
    "appointment": "patient_id BIGINT, date TIMESTAMP, status STRING",
    "chats": "id BIGINT, patient_id BIGINT, consultant_id BIGINT",
    "messages": "chat_id BIGINT, sender BIGINT, messaged_at TIMESTAMP",
    "patientsideeffects": "patient_id BIGINT, type STRING, creator STRING, date TIMESTAMP",
    "assistant": None,  # open schema with a created_at timestamp
    "sheet": (
        "row_no BIGINT, name STRING, not_onboarding_reason STRING, glp_1st_dose STRING, "
        "meal_logging_reason STRING, weight_logging_reason STRING"
    ),
    "existing_leads": "phone_key STRING",
}

# Source column names that differ from ours.
SOURCE_NAMES = {"createdAt": "created_at", "isActive": "is_active", "messagedAt": "messaged_at"}


def snake_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(SOURCE_NAMES)


def load_role(spark: SparkSession, folder: str, role: str) -> DataFrame:
    """A role table stored as ``<folder>/<role>.parquet`` (file or directory).

    The files' own columns are read, renamed by ``SOURCE_NAMES`` and cast to the role's
    types; a column the role needs and the files lack is an error, never NULLs.
    """
    stored = snake_columns(spark.read.parquet(f"{folder}/{role}.parquet"))
    if ROLE_SCHEMAS[role] is None:
        return stored
    wanted = T.StructType.fromDDL(ROLE_SCHEMAS[role])
    absent = [f.name for f in wanted if f.name not in stored.columns]
    if absent:
        raise ValueError(f"role {role}: no column {', '.join(absent)} in {folder}/{role}.parquet")
    return stored.select(*[_typed(stored, f) for f in wanted])


def _typed(stored: DataFrame, wanted: T.StructField) -> Column:
    """The column as the role has it.  Equal types are left alone, so that filters reach the scan."""
    c = F.col(wanted.name)
    return c if stored.schema[wanted.name].dataType == wanted.dataType else c.cast(wanted.dataType).alias(wanted.name)


def folder_reader(spark: SparkSession, folder: str):
    """Role reader over a folder of role tables; every role is planned once."""
    return cache(lambda role: load_role(spark, folder, role))
