"""What a report run is given: role tables, the as-of day and its parameters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from . import fixed_values as fv

RoleReader = Callable[[str], DataFrame]

# Days are cut in the session zone; role tables hold UTC.
_UTC = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None)


@dataclass(frozen=True)
class ReportContext:
    """Inputs of a run.  ``as_of`` stands for "today" everywhere, so a run can be repeated."""

    spark: SparkSession
    read: RoleReader
    as_of: dt.date
    zone: str = "Asia/Kolkata"
    # Ids whose patients a cohort has; None: everyone's.
    nutritionists: tuple[int, ...] | None = None
    excluded_glp_plans: tuple[str, ...] = fv.EXCLUDED_GLP_PLANS
    # Coach+App compares today's notes that name a consultant with all of yesterday's notes.
    coach_prev_any_note: bool = True
    streak_start: dt.date = dt.date(2024, 1, 1)
    # Phones of the followed team: a short tuple, or a DataFrame with one `phone` column; None: all patients.
    team_phones: tuple[str, ...] | DataFrame | None = None
    team_excluded_names: tuple[str, ...] = ()
    window_mode: str = "literal"
    # How a user finds their weights for the progress status: by "name" (equal names share the
    # status of the last) or by "id".
    progress_key: str = "name"
    lead_source: str = "App Signup"
    lead_system: str = "member app"
    # When the run was started, UTC; it appears in lead notes only.
    run_ts: dt.datetime = field(default_factory=_now)
    # Patients the run is about (see plans.registry.scope_to); None: everyone.
    scope: DataFrame | None = None
    _memo: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self) -> None:
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        if zone not in _UTC:
            raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")

    def role(self, name: str) -> DataFrame:
        return self.read(name)

    def facts(self, name: str) -> DataFrame:
        """A role with a ``patient_id``, only the patients in scope.

        A semi join without a hint: where Spark finds the written ids small enough it
        broadcasts them, and rows of other patients go before any shuffle.
        """
        if self.scope is None:
            return self.role(name)
        return self.role(name).join(self.scope, "patient_id", "left_semi")

    @property
    def yesterday(self) -> dt.date:
        return self.days_back(1)

    def days_back(self, n: int) -> dt.date:
        return self.as_of - dt.timedelta(days=n)

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The frame kept under ``name`` by :func:`plans.registry.pin`, or a fresh lazy plan."""
        return self._memo.get(name) or build()

    def holds(self, name: str) -> bool:
        return name in self._memo

    def pinned(self, frames: dict[str, DataFrame]) -> ReportContext:
        return replace(self, _memo={**self._memo, **frames})
