"""Small hand-made role tables for tests.  All values are invented."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from cohortlane import ReportContext
from cohortlane.sources.roles import ROLE_SCHEMAS

AS_OF = dt.date(2024, 1, 31)
RUN_TS = dt.datetime(2024, 1, 31, 6)
ASSISTANT = "id BIGINT, message STRING, created_at TIMESTAMP"


def at(day: int, hour: int = 9, month: int = 1) -> dt.datetime:
    return dt.datetime(2024, month, day, hour, tzinfo=dt.timezone.utc)


def tables(spark: SparkSession, rows: dict[str, list[tuple]]) -> dict[str, DataFrame]:
    """Every role, empty unless rows are given."""
    return {
        role: spark.createDataFrame(rows.get(role, []), schema or ASSISTANT)
        for role, schema in ROLE_SCHEMAS.items()
    }


def context(spark: SparkSession, rows: dict[str, list[tuple]], **params) -> ReportContext:
    frames = tables(spark, rows)
    defaults = {"as_of": AS_OF, "nutritionists": (2, 4), "streak_start": dt.date(2024, 1, 5), "run_ts": RUN_TS}
    return ReportContext(spark=spark, read=frames.__getitem__, **{**defaults, **params})


def patient(pid: int, **changes) -> tuple:
    values = {
        "id": pid,
        "firstname": f"Name{pid}",
        "middlename": None,
        "lastname": "Test",
        "phone": f"90000{pid:05d}",
        "email": None,
        "created_at": at(30, 8),
        "is_active": True,
        "status": "ACTIVE_SUBSCRIPTION",
        "active_subscription_id": 1,
        "nutritionist_id": 2,
        "start_weight": 100.0,
        "goal_weight": 80.0,
        "target_duration": 90,
        "subscription_start_date": dt.date(2024, 1, 1),
        "subscription_end_date": dt.date(2024, 6, 1),
    }
    values.update(changes)
    return tuple(values.values())


PLANS = [(1, "Plain", "Coach+App"), (2, "Strong", "GLP"), (3, "Metabolic Screening", "GLP"), (4, "X", "Other")]
