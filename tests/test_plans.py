"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest

from cohortlane.operators import filters
from cohortlane.plans import features, leads, registry, reports, streaks
from cohortlane.sources.roles import folder_reader
from cohortlane_checks.queries import QUERIES, followed, make_context
from tests.fixtures import PLANS, at, context, patient, tables

# report_output writes tables when it is built; its reports are the ones of report_registry.
WRITES = ("report_output",)
PLANNED = [name for name in QUERIES if name not in WRITES]
FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    for key, value in values.items():
        spark.conf.set(key.replace("__", "."), value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key.replace("__", "."))


def test_no_python_and_no_cross_join_anywhere(ctx):
    for name in PLANNED:
        plan = plan_of(QUERIES[name](ctx))
        assert not [node for node in FORBIDDEN if node in plan], name


def test_no_broadcast_hint_in_any_plan(ctx):
    for name in ("annotated_users", "team_streaks", "lead_sync", "full_analytics", "actions_required"):
        logical = QUERIES[name](ctx)._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in logical and "UnresolvedHint" not in logical, name


@pytest.mark.parametrize("name", ["annotated_users", "summary_final", "team_streaks", "lead_sync"])
def test_same_result_when_nothing_can_be_broadcast(spark, folder, name):
    usual = sorted(map(str, QUERIES[name](make_context(spark, folder)).collect()))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        df = QUERIES[name](make_context(spark, folder))
        assert sorted(map(str, df.collect())) == usual
        assert "BroadcastExchange" not in plan_of(df)


@pytest.mark.parametrize("name", ["annotated_users", "lead_sync", "join_subscription", "chat_message_join"])
def test_same_result_when_skewed_partitions_are_split(spark, folder, name):
    usual = sorted(map(str, QUERIES[name](make_context(spark, folder)).collect()))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.0",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1000",
    ):
        assert sorted(map(str, QUERIES[name](make_context(spark, folder)).collect())) == usual


def test_features_shuffle_once_per_fact_row(ctx):
    """All log tables share one exchange of fact rows, by patient and day word, combined on the map side.

    Active days come from the same pass as day sets: the words then meet by patient in a second
    exchange of one row per patient and word, which replaces the separate distinct over the logs.
    """
    plan = plan_of(features.engagement(ctx, prev=True, active=True)).split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(patient_id#\d+L, day_word", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(patient_id#\d+L, \d+\)", plan)) == 1
    assert "SortAggregate" not in plan and "Expand" not in plan
    assert plan.count("partial_bit_or(day_bit") == 1
    fact_level = plan.split("Exchange hashpartitioning(patient_id")[-1]
    assert fact_level.count("partial_max(has_food") == 1


def test_features_without_days_shuffle_fact_rows_once(ctx):
    plan = plan_of(features.engagement(ctx, prev=True)).split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(patient_id", plan)) == 1
    assert plan.count("partial_max(has_food") == 1


def test_streaks_add_no_shuffle_after_the_window(ctx):
    from cohortlane.operators.windows import streak_marks

    plan = plan_of(streak_marks(streaks.daily_logs(ctx), ctx.yesterday, ctx.streak_start))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_top_row_window_limits_before_the_shuffle(ctx):
    plan = plan_of(QUERIES["row_number_eq_1"](ctx))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("roles"))
    rows = {
        "patients": [patient(1)],
        "subscriptions": PLANS,
        "metrics": [(1, 1, "BODY_WEIGHT", 90.0, at(20), at(20))],
        "assistant": [(1, "x", at(30))],
    }
    for role, df in tables(spark, rows).items():
        df.write.parquet(f"{folder}/{role}.parquet")
    ctx = context(spark, {})
    return type(ctx)(**{**ctx.__dict__, "read": folder_reader(spark, folder), "_memo": {}})


def pushed(df) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_of(df))


def test_day_filters_reach_the_scan(stored):
    assert "GreaterThanOrEqual(created_at" in pushed(leads.report_contact_leads(stored))[0]
    assert "LessThan(created_at" in pushed(leads.signups(stored))[0]
    for scan in pushed(streaks.daily_logs(stored)):
        assert "GreaterThanOrEqual(date" in scan and "LessThan(date" in scan
    for scan in pushed(features.recent_active_days(stored)):
        assert "GreaterThanOrEqual(date" in scan


def test_cohort_filters_reach_the_scan(stored):
    scan = next(s for s in pushed(filters.active_cohort(stored)) if "is_active" in s)
    for part in ("EqualTo(is_active,true)", "EqualTo(status", "subscription_end_date", "nutritionist_id"):
        assert part in scan


def test_scans_read_only_what_is_used(stored):
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_of(features.weights(stored)))
    assert len(schemas) == 1
    assert set(re.findall(r"(\w+):", schemas[0])) == {"patient_id", "event_id", "name", "value", "date", "created_at"}
    notes = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_of(features.engagement(stored)))
    assert not [s for s in notes if "description" in s]


def test_every_report_is_planned(stored):
    assert list(registry.run_reports(stored)) == list(registry.ALL)
    assert len(reports.report_full_analytics(stored).columns) == 22


def test_scoped_runs_carry_no_hint(spark, folder, tmp_path):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        ctx = followed(make_context(spark, folder))
        small = registry.scope_to(ctx, features.cohort_base(ctx), str(tmp_path / "s"))
        team = registry.scope_to(ctx, streaks.team_targets(ctx), str(tmp_path / "t"))
        pinned = registry.pin(ctx, str(tmp_path / "p"))
        frames = [features.wide(small, prev=True, active=True), streaks.team_streaks(team), *registry.run_reports(pinned).values()]
        for df in frames:
            assert "BroadcastExchange" not in plan_of(df)


def test_pinned_reports_join_no_features(spark, folder, tmp_path):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        pinned = registry.pin(make_context(spark, folder), str(tmp_path))
        assert "Join" not in plan_of(reports.full_table(pinned))
        assert "Join" not in plan_of(reports.user_table(pinned))


FACTS = ("events", "orders", "conversations", "customer")


def scans(plan: str) -> dict[str, int]:
    found = re.findall(r"FileScan parquet [^\n]*?/(\w+)\.parquet\]", plan)
    return {name: found.count(name) for name in FACTS}


def test_final_summary_reads_its_frame_and_not_the_facts(ctx):
    """The patients are scanned once, when the wide frame is written; what is left is the sheet."""
    counts = scans(plan_of(QUERIES["summary_final"](ctx)))
    assert counts["customer"] <= 1 and not any(counts[f] for f in FACTS[:3])


def test_single_reports_leave_out_joins_they_do_not_need(ctx):
    plan = plan_of(reports.progress_inputs(ctx))
    assert scans(plan)["conversations"] == 0 and scans(plan)["orders"] == 0


def test_scope_drops_other_patients_before_the_aggregation(spark, ctx, tmp_path):
    small = registry.scope_to(ctx, features.cohort_base(ctx), str(tmp_path))
    assert small.scope.count() == features.cohort_base(ctx).count()
    plan = plan_of(features.weights(small))
    join, aggregate = plan.index("BroadcastHashJoin"), plan.index("partial_max_by")
    assert aggregate < join  # plans are printed top-down: the join lies below
    in_scope = features.weights(ctx).join(small.scope, "patient_id", "left_semi")
    assert features.weights(small).exceptAll(in_scope).count() == 0
    assert features.weights(small).count() == in_scope.count()
    ctx = followed(ctx)
    streaks_small = streaks.team_streaks(registry.scope_to(ctx, streaks.team_targets(ctx), str(tmp_path / "t")))
    assert streaks_small.exceptAll(streaks.team_streaks(ctx)).count() == 0


def test_cohorts_do_not_overlap(ctx):
    both = filters.active_cohort(ctx).select("id", "cohort")
    parts = [filters.active_cohort(ctx, kind).select("id", "cohort") for kind in filters.COHORTS]
    assert both.exceptAll(parts[0].union(parts[1])).count() == 0
    assert both.count() == parts[0].count() + parts[1].count()


def test_cohort_is_shuffled_once_for_all_feature_joins(spark, folder):
    """Every feature frame is partitioned by patient already; the joins add no further exchange."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(reports.full_table(make_context(spark, folder)))
    joins = re.findall(r"SortMergeJoin \[patient_id#\d+L?\], \[patient_id", plan)
    exchanges = re.findall(r"Exchange hashpartitioning\(patient_id#\d+L, 8\)", plan)
    assert len(joins) == 3  # engagement (with active days as day sets), weight, note
    assert len(exchanges) == 1 + len(joins)
