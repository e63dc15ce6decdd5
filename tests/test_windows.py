"""Latest rows and streaks against brute force."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from cohortlane.functions.measures import round2
from cohortlane.operators import windows
from cohortlane.operators.joins import logs_by_day
from cohortlane.plans import streaks
from tests.fixtures import AS_OF, at, context, patient

METRICS = "patient_id BIGINT, event_id BIGINT, name STRING, value DOUBLE, date TIMESTAMP, created_at TIMESTAMP"
YESTERDAY = dt.date(2024, 1, 30)


def weights(df, as_of=None):
    return {r.patient_id: r.current_weight for r in windows.latest_weight(df, as_of).collect()}


def test_latest_weight_null_date_and_ties(spark):
    rows = [
        (1, 1, "BODY_WEIGHT", 70.0, at(20), at(20)),
        (1, 2, "BODY_WEIGHT", 71.0, None, at(2)),  # no date: counts as the newest
        (2, 3, "BODY_WEIGHT", 80.0, at(20), at(20)),
        (2, 4, "BODY_WEIGHT", 81.0, at(20), at(21)),  # same date, created later
        (3, 5, "BODY_WEIGHT", 90.0, at(20), at(20)),
        (3, 6, "BODY_WEIGHT", 91.0, at(20), at(20)),  # tie on both: the higher id
        (4, 7, "BODY_FAT", 30.0, at(20), at(20)),
        (5, 8, "BODY_WEIGHT", 60.0, at(20), at(20)),
        (5, 9, "BODY_WEIGHT", None, at(21), at(21)),  # latest value unknown
    ]
    df = spark.createDataFrame(rows, METRICS)
    assert weights(df) == {1: 71.0, 2: 81.0, 3: 91.0, 5: None}
    assert weights(df, dt.date(2024, 1, 21)) == {1: 70.0, 2: 81.0, 3: 91.0, 5: 60.0}


def test_replay_for_an_earlier_day_equals_filtered_facts(spark, ctx):
    metrics = ctx.role("metrics")
    cut = dt.date(2024, 1, 20)
    earlier = metrics.filter(F.col("date") < F.lit(cut))
    assert weights(metrics, cut) == weights(earlier)


def test_max_by_and_window_agree(ctx):
    ranked = windows.first_ranked(
        ctx.role("metrics").filter("name = 'BODY_WEIGHT'"), ["patient_id"], *windows.WEIGHT_ORDER
    )
    rounded = ranked.select("patient_id", round2(F.col("value")).alias("value")).collect()
    assert weights(ctx.role("metrics")) == {r.patient_id: r.value for r in rounded}


def streak_of(active: set[dt.date], last: dt.date, start: dt.date) -> int:
    n = 0
    while last >= start and last in active:
        n, last = n + 1, last - dt.timedelta(days=1)
    return n


def test_streaks_match_brute_force(spark):
    rng = random.Random(3)
    start = dt.date(2024, 1, 5)
    days = [AS_OF - dt.timedelta(days=i) for i in range(-2, 40)]  # from the future back past the start
    logs = {role: [] for role in ("patientfoodlogs", "patienthabitlogs", "activity")}
    seen = {role: {} for role in logs}
    for pid in range(60):
        density = rng.choice([0.0, 0.5, 0.9, 1.0])
        for role in logs:
            for d in days:
                if rng.random() < density:
                    for _ in range(rng.choice([1, 1, 3])):
                        logs[role].append((pid, at(1).replace(year=d.year, month=d.month, day=d.day)))
                    seen[role].setdefault(pid, set()).add(d)
    ctx = context(
        spark,
        {"patients": [patient(p) for p in range(60)], **logs},
        team_phones=tuple(f"90000{p:05d}" for p in range(60)),
    )
    got = {r.patient_id: r for r in streaks.team_streaks(ctx).collect()}
    both = {
        p: seen["patientfoodlogs"].get(p, set()) & seen["activity"].get(p, set()) for p in range(60)
    }
    alone = windows.current_streak(
        streaks.daily_logs(ctx).filter("food AND activity"), YESTERDAY, start
    )
    short = {r.patient_id: r.streak for r in alone.collect()}
    for p in range(60):
        expected = streak_of(both[p], YESTERDAY, start)
        assert got[p].streak == expected
        assert short.get(p, 0) == expected
        strict = all(YESTERDAY in seen[role].get(p, set()) for role in logs)
        assert got[p].active_yesterday == ("Yes" if strict else "No")
        if strict:
            assert expected >= 1


def test_streak_lengths_over_the_test_tables(ctx):
    """At sf0.01 the lengths are known from an independent count."""
    marks = windows.streak_marks(streaks.daily_logs(ctx), ctx.yesterday, ctx.streak_start)
    counts = {r.streak: r.n for r in marks.groupBy("streak").agg(F.count("*").alias("n")).collect()}
    counts.pop(None, None)
    assert counts == {1: 34, 2: 18, 3: 5, 4: 4, 5: 2, 6: 1}


def test_start_after_yesterday_gives_no_streak(spark):
    logs = {r: [(1, at(30))] for r in ("patientfoodlogs", "patienthabitlogs", "activity")}
    ctx = context(
        spark,
        {"patients": [patient(1)], **logs},
        team_phones=("9000000001",),
        streak_start=dt.date(2024, 2, 5),
    )
    row = streaks.team_streaks(ctx).first()
    assert (row.active_yesterday, row.streak, row.reason) == ("Yes", 0, "Active")


def test_islands_number_runs_of_equal_flags(spark):
    flags = "TTFFTT"
    rows = [(1, dt.date(2024, 1, 1 + i), f == "T") for i, f in enumerate(flags)]
    df = spark.createDataFrame(rows, "patient_id INT, day DATE, flag BOOLEAN")
    got = windows.islands(df, "patient_id", "day", "flag").orderBy("day").collect()
    runs = [(r.flag, r.island) for r in got]
    assert runs[0] == runs[1] and runs[2] == runs[3] and runs[4] == runs[5]
    assert len(set(runs)) == 3


def test_logs_by_day_ignores_undated_rows_with_condition(spark):
    food = spark.createDataFrame([(1, None), (1, at(3)), (1, at(3, 20))], "patient_id BIGINT, date TIMESTAMP")
    none = spark.createDataFrame([], "patient_id BIGINT, date TIMESTAMP")
    got = logs_by_day({"food": food, "habit": none}, F.col("date").isNotNull()).collect()
    assert [(r.check_date, r.food, r.habit) for r in got] == [(dt.date(2024, 1, 3), True, False)]


def test_excluded_team_names(spark):
    people = [patient(1, firstname="Ann", lastname="Lee"), patient(2, firstname=" BOB ", lastname=None)]
    ctx = context(
        spark,
        {"patients": people},
        team_phones=("9000000001", "9000000002"),
        team_excluded_names=("bob",),
    )
    assert [r.name for r in streaks.team_targets(ctx).collect()] == ["Ann Lee"]


def test_streaks_over_many_words_equal_walking_back(spark):
    """Runs longer than one word of 64 days, starts years back, gaps, days before the start."""
    last = dt.date(2024, 1, 30)
    start = last - dt.timedelta(days=900)
    rng = random.Random(11)
    rows = []
    runs = {1: 0, 2: 63, 3: 64, 4: 65, 5: 130, 6: 901, 7: 950}
    for pid, length in runs.items():
        rows += [(pid, last - dt.timedelta(days=k), True, False, True) for k in range(length)]
    rows += [(8, last - dt.timedelta(days=k), True, False, rng.random() < 0.9) for k in range(300)]
    rows += [(9, last - dt.timedelta(days=1), True, False, True)]
    days = spark.createDataFrame(rows, "patient_id long, check_date date, food boolean, habit boolean, activity boolean")

    def walked(pid):
        mine = {d for p, d, food, _, act in rows if p == pid and food and act}
        n, d = 0, last
        while d in mine and d >= start:
            n, d = n + 1, d - dt.timedelta(days=1)
        return n or None

    got = {r.patient_id: r.streak for r in windows.streak_marks(days, last, start).collect()}
    assert got == {pid: walked(pid) for pid in range(2, 10)}
    assert got[7] == 901 and got[4] == 65
    plain = days.filter("food AND activity").select("patient_id", "check_date")
    found = {r.patient_id: r.streak for r in windows.current_streak(plain, last, start).collect()}
    assert found == {pid: n for pid in range(2, 10) if (n := walked(pid))}


def test_team_streaks_order_no_days_by_window(spark):
    ctx = context(spark, {"patients": [patient(1)]})
    plan = streaks.team_streaks(ctx)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
