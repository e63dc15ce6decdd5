"""User reports on random small tables against a plain-Python evaluation."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from cohortlane import fixed_values as fv
from cohortlane.operators import aggregates, filters
from cohortlane.plans import features, registry, reports, streaks
from tests.fixtures import AS_OF, PLANS, at, context, patient

CONSULTANTS = [(2, "Cleo"), (3, "Dana")]  # nutritionist 4 has no entry
DAY = dt.timedelta(days=1)


def world(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)

    def when(null=0.1):
        return None if rng.random() < null else at(1) + dt.timedelta(days=rng.randrange(-20, 33), hours=rng.randrange(9))

    people = []
    for pid in range(40):
        people.append(
            patient(
                pid,
                firstname=rng.choice([f" N{pid} ", f"N{pid % 5}", "  ", None]),
                active_subscription_id=rng.choice([1, 1, 2, 2, 3, 4]),
                nutritionist_id=rng.choice([2, 2, 4, 9]),
                start_weight=rng.choice([100.0, 90.5, None]),
                goal_weight=rng.choice([80.0, 70.25, 120.0, None]),
                target_duration=rng.choice([90, 30, 0, None]),
                subscription_start_date=rng.choice([dt.date(2024, 1, 1), dt.date(2024, 1, 31), None]),
                subscription_end_date=rng.choice([dt.date(2024, 1, 31), dt.date(2024, 1, 30), dt.date(2024, 5, 1)]),
                is_active=rng.random() < 0.9,
            )
        )

    def some(n, *make):
        return [tuple(m() for m in make) for _ in range(n)]

    def pid():
        return 7 if rng.random() < 0.33 else rng.randrange(45)

    counter = iter(range(10**6))
    metrics = some(
        200,
        pid,
        lambda: next(counter),
        lambda: rng.choice(["BODY_WEIGHT", "BODY_WEIGHT", "BODY_FAT", "PULSE"]),
        lambda: rng.choice([None, 88.125, 95.0, 71.3]),
        when,
        lambda: when(0),
    )
    return {
        "patients": people,
        "subscriptions": PLANS,
        "consultants": CONSULTANTS,
        "metrics": metrics,
        "patientfoodlogs": some(90, pid, when),
        "activity": some(60, pid, when),
        "patientnotes": some(60, lambda: next(counter), pid, lambda: rng.choice([None, 2, 4]), when, lambda: f"note {next(counter)}"),
        "appointment": some(40, pid, when, lambda: rng.choice(["COMPLETED", "CANCELLED"])),
        "chats": [(i, i, rng.choice([2, 4])) for i in range(40)],
        "messages": some(90, pid, lambda: rng.choice([2, 4, -1]), when),
        "patientsideeffects": some(
            80, pid, lambda: rng.choice(["Good", "Nausea", "Ache"]), lambda: rng.choice(["PATIENT", "COACH"]), when
        ),
    }


def day_of(ts):
    return None if ts is None else ts.date()


def gap(later, earlier):
    return None if earlier is None else (later - earlier).days


def latest(values):
    values = [v for v in values if v is not None]
    return max(values) if values else None


class Brute:
    """The report definitions, one patient at a time."""

    def __init__(self, rows):
        self.rows = rows
        self.plans = {p[0]: p for p in rows["subscriptions"]}

    def cohort(self):
        for p in self.rows["patients"]:
            plan = self.plans[p[9]]
            kind = plan[2]
            listed = kind == fv.COACH_APP or (kind == fv.GLP and plan[1].lower() not in fv.EXCLUDED_GLP_PLANS)
            name = p[1]
            if listed and p[7] and p[8] == fv.ACTIVE_STATUS and p[15] >= AS_OF and name and name.strip() and p[10] in (2, 4):
                yield p, kind, plan

    def facts(self, role, pid, position=0):
        return [r for r in self.rows[role] if r[position] == pid]

    def contacts(self, pid, before=None, any_note=False):
        days = [day_of(n[3]) for n in self.facts("patientnotes", pid, 1) if any_note or n[2] is not None]
        days += [day_of(a[1]) for a in self.facts("appointment", pid) if a[2] == "COMPLETED"]
        for chat in self.facts("chats", pid, 1):
            days += [day_of(m[2]) for m in self.facts("messages", chat[0]) if m[1] == chat[2]]
        return [d for d in days if d is not None and (before is None or d < before)]

    def weight(self, pid, before=None):
        rows = [m for m in self.facts("metrics", pid) if m[2] == "BODY_WEIGHT"]
        if before is not None:
            rows = [m for m in rows if m[4] is not None and m[4].date() < before]
        if not rows:
            return None
        floor = at(1).replace(year=1)
        best = max(rows, key=lambda m: (m[4] is None, m[4] or floor, m[5], m[1]))
        return None if best[3] is None else float(f"{best[3] + 1e-9:.2f}")

    def flags(self, p, today, before):
        pid = p[0]

        def counts(ts):
            return before is None or (ts is not None and ts.date() < before)

        meals = [f[1] for f in self.facts("patientfoodlogs", pid) if counts(f[1])]
        fats = [m for m in self.facts("metrics", pid) if m[2] == "BODY_FAT" and counts(m[4])]
        weighed = [m[4] for m in self.facts("metrics", pid) if m[2] == "BODY_WEIGHT" and counts(m[4])]
        onboarded = p[11] is not None and p[12] is not None and fats and meals
        return {
            "onboarded": "Yes" if onboarded else "No",
            "meal": "Yes" if any(t and t.date() >= today - 3 * DAY for t in meals) else "No",
            "weight": "Yes" if any(t and t.date() >= today - 7 * DAY for t in weighed) else "No",
            "track": self.track(p, self.weight(pid, before), today),
        }

    @staticmethod
    def track(p, current, today):
        start, goal, duration, begun = p[11], p[12], p[13], p[14]
        if None in (current, start, goal, duration, begun) or duration <= 0:
            return fv.DATA_INCOMPLETE
        if start <= goal:
            return fv.GOAL_ACHIEVED
        planned = (start - goal) / duration * max(0, (today - begun).days)
        return fv.ON_TRACK if start - current >= planned else fv.OFF_TRACK

    def active_days(self, pid):
        days = {
            day_of(r[i])
            for role, i in (("activity", 1), ("patientfoodlogs", 1), ("metrics", 4))
            for r in self.facts(role, pid)
        } - {None}
        return days

    def effects(self, pid):
        rows = self.facts("patientsideeffects", pid)
        floor = dt.datetime(2024, 1, 24, tzinfo=dt.timezone.utc)
        texts = [r[1] for r in rows if r[2] == "PATIENT" and r[3] and r[3] >= floor and r[1] != "Good"]
        return ", ".join(sorted(texts)) or "None"


@pytest.mark.parametrize("seed", [1, 2])
def test_user_table(spark, seed):
    rows = world(seed)
    brute, ctx = Brute(rows), context(spark, rows)
    got = {r.patient_id: r for r in reports.user_table(ctx).collect()}
    names = dict(CONSULTANTS)
    cohort = list(brute.cohort())
    assert set(got) == {p[0] for p, _, _ in cohort} and got
    for p, kind, plan in cohort:
        row, flags = got[p[0]], brute.flags(p, AS_OF, None)
        days = brute.active_days(p[0])
        assert (row.cohort, row.plan_name, row.patient_name) == (kind, plan[1], p[1].strip())
        assert row.consultant_name == names.get(p[10])
        assert (row.user_onboarded, row.meal_log, row.weight_log) == (flags["onboarded"], flags["meal"], flags["weight"])
        assert row.days_since_contact == gap(AS_OF, latest(brute.contacts(p[0])))
        assert row.active_days == len({d for d in days if d >= AS_OF - 7 * DAY})
        assert row.last_active_day == latest(days)
        assert row.side_effects == brute.effects(p[0])


@pytest.mark.parametrize("seed", [1, 2])
def test_summary_matrix(spark, seed):
    rows = world(seed)
    brute, ctx = Brute(rows), context(spark, rows)
    want = {(m, c): 0 for m in range(1, 8) for c in ("coach_today", "coach_yesterday", "glp_today", "glp_yesterday")}
    yesterday = AS_OF - DAY
    for p, kind, _ in brute.cohort():
        short = "coach" if kind == fv.COACH_APP else "glp"
        views = [("today", brute.flags(p, AS_OF, None), gap(AS_OF, latest(brute.contacts(p[0]))))]
        if p[14] is not None and p[14] <= yesterday:
            contacts = brute.contacts(p[0], before=AS_OF, any_note=kind == fv.COACH_APP)
            views.append(("yesterday", brute.flags(p, yesterday, AS_OF), gap(yesterday, latest(contacts))))
        for day, flags, idle in views:
            hits = [
                True,
                flags["onboarded"] == "No",
                flags["track"] == fv.ON_TRACK,
                flags["track"] == fv.OFF_TRACK,
                idle is None or idle > 2,
                flags["meal"] == "No",
                flags["weight"] == "No",
            ]
            for i, hit in enumerate(hits, start=1):
                want[i, f"{short}_{day}"] += hit
    got = {}
    for r in aggregates.summary_matrix(features.summary_features(ctx)).collect():
        for c in ("coach_today", "coach_yesterday", "glp_today", "glp_yesterday"):
            got[r.sort_order, c] = r[c]
    assert got == want


def test_full_table_note_and_contact(spark):
    rows = {
        "patients": [patient(1), patient(2)],
        "subscriptions": PLANS,
        "patientnotes": [
            (1, 1, 2, at(20), "older"),
            (2, 1, 2, at(25), "first of the day"),
            (3, 1, 2, at(25), "second of the day"),
            (4, 1, None, at(30), "no consultant"),
            (5, 2, 2, at(20), "dated"),
            (6, 2, 2, None, "undated counts as newest"),
        ],
        "appointment": [(2, at(10), "COMPLETED")],
    }
    got = {r.patient_id: r for r in reports.full_table(context(spark, rows)).collect()}
    assert got[1].last_note == "second of the day"
    assert got[1].days_since_contact == 6
    assert got[2].last_note == "undated counts as newest"
    assert got[2].last_note_date is None
    assert got[2].days_since_contact == 21  # the undated note has no day to count from
    assert got[1].expected_loss == 6.67
    assert got[1].actual_loss is None


def test_summary_delta_texts(spark):
    matrix = spark.createDataFrame(
        [(1, "a", 5, 3, 0, 0), (2, "b", 1, 4, 2, 2)],
        "sort_order INT, metric STRING, coach_today LONG, coach_yesterday LONG, glp_today LONG, glp_yesterday LONG",
    )
    got = [(r.coach_app, r.glp) for r in aggregates.summary_delta(matrix).orderBy("sort_order").collect()]
    assert got == [("5 (+2)", "0 (+0)"), ("1 (-3)", "2 (+0)")]


def test_summary_of_empty_tables_is_all_zero(spark):
    rows = reports.report_summary_comparison(context(spark, {})).collect()
    assert len(rows) == 7
    assert {r["GLP (vs Yesterday)"] for r in rows} == {"0 (+0)"}


SHEET = [
    (1, "  NAME1 ", "Waiting for scale", "2024-01-01", "Travelling", ""),
    (2, "name1", "No phone", "5 Jan 2024", "", "Scale broken"),  # same name further down: wins
    (3, " ", "nobody", "", "", ""),
    (4, "Name2", "", "n/a", "", ""),
]


def annotated(spark, **changes):
    params = {"team_phones": ("9000000001", "9000000009")}
    logs = [(pid, at(30)) for pid in (1, 9)]  # patient 9 is followed but in no cohort
    rows = {
        "patientfoodlogs": logs[1:],
        "patienthabitlogs": logs,
        "activity": logs[1:],
        "patients": [
            patient(1, **changes),
            patient(2),
            patient(3, active_subscription_id=2),
            patient(9, active_subscription_id=4),
        ],
        "subscriptions": PLANS,
        "consultants": CONSULTANTS,
        "metrics": [(1, 1, "BODY_WEIGHT", 90.0, at(20), at(20))],
        "sheet": SHEET,
    }
    return context(spark, rows, **params)


def test_annotation_takes_the_last_sheet_row(spark):
    got = {r.patient_id: r for r in reports.annotated_table(annotated(spark)).collect()}
    assert got[1].user_onboarded == "No phone"
    assert got[1].meal_log == "No"  # the winning row gives no meal reason
    assert got[1].weight_log == "Scale broken"
    assert got[1].cell_classes == {
        "User Onboarded": fv.CELL_REASON,
        "Weight Log (7 days)": fv.CELL_REASON,
    }
    assert got[1].track == fv.ON_TRACK  # 10 lost, 26 days at 20 / 90 expected
    assert (got[2].track, got[2].cell_classes) == (fv.DATA_INCOMPLETE, {})
    assert got[3].track == fv.DATA_INCOMPLETE


def test_equal_names_share_the_last_analytics_row(spark):
    ctx = annotated(spark, firstname="Name2")
    names = reports.analytics_lookup(reports.progress_inputs(ctx)).collect()
    row = next(r for r in names if r.name_key == "name2")
    assert row.current_weight is None  # patient 2 comes after patient 1


def test_recount_counts_everything_else_as_off_track(spark):
    final = {r["Metric"]: r for r in reports.report_summary_final(annotated(spark)).collect()}
    assert final[fv.METRIC_ON_TRACK]["Coach + App (vs Yesterday)"] == "1"
    assert final[fv.METRIC_OFF_TRACK]["Coach + App (vs Yesterday)"] == "1"
    assert final[fv.METRIC_OFF_TRACK]["GLP (vs Yesterday)"] == "1"
    assert final[fv.METRIC_PAID]["GLP (vs Yesterday)"] == "1 (+0)"


def test_recount_is_skipped_for_an_empty_cohort(spark):
    ctx = annotated(spark)
    coach = reports.annotated_table(ctx).filter("cohort = 'Coach+App'")
    summary = reports.summary_table(ctx)
    assert aggregates.recount(summary, coach).exceptAll(summary).count() == 0


def test_actions_leave_out_replaced_cells(spark):
    got = {
        (r["Consultant"], r["Action"]): r["Patients Pending"]
        for r in reports.report_actions_required(annotated(spark)).collect()
    }
    assert got == {
        ("Cleo", fv.ACTION_ONBOARDING): "Name2, Name3",
        ("Cleo", fv.ACTION_MEAL): "Name1, Name2, Name3",
        ("Cleo", fv.ACTION_WEIGHT): "Name2, Name3",
    }


def test_actions_with_many_equal_names_and_unknown_consultant(spark):
    schema = (
        "consultant_name STRING, patient_name STRING, user_onboarded STRING, meal_log STRING, "
        "weight_log STRING, days_since_contact INT"
    )
    people = [("Cleo", f"P{i % 50:02d}", "No", "Yes", "Yes", i % 4) for i in range(600)]
    people += [(None, "Solo", "Yes", "no", "Yes", None)]
    got = {
        (r.consultant, r.action): r.patients
        for r in aggregates.consultant_actions(spark.createDataFrame(people, schema)).collect()
    }
    names = sorted(p[1] for p in people[:-1])
    late = sorted(f"{p[1]} ({p[5]} days)" for p in people[:-1] if p[5] >= 2)
    assert got == {
        ("Cleo", fv.ACTION_ONBOARDING): ", ".join(names),
        ("Cleo", fv.ACTION_CONTACT): ", ".join(late),
        (fv.UNKNOWN_CONSULTANT, fv.ACTION_MEAL): "Solo",
    }


def test_one_failing_report_does_not_stop_the_others(spark, tmp_path):
    ctx = annotated(spark)

    def read(role):
        if role == "assistant":
            raise OSError("table is gone")
        return ctx.read(role)

    broken = type(ctx)(**{**ctx.__dict__, "read": read, "_memo": {}})
    names = [fv.TITLE_CONTACT_LEADS, fv.TITLE_SIGNUPS]
    paths, failures = registry.publish(broken, str(tmp_path), names)
    assert list(paths) == [fv.TITLE_SIGNUPS]
    assert "table is gone" in failures[fv.TITLE_CONTACT_LEADS]
    with pytest.raises(OSError):
        registry.publish(broken, str(tmp_path / "strict"), names, strict=True)


def test_pinned_frames_give_the_same_reports(spark, tmp_path):
    ctx = annotated(spark)
    pinned = registry.pin(ctx, str(tmp_path))
    assert (tmp_path / "scope").exists() and pinned.scope is None
    for name, frame in registry.run_reports(pinned).items():
        usual = registry.ALL[name](ctx)
        assert sorted(map(str, frame.collect())) == sorted(map(str, usual.collect())), name


def test_published_tables_mark_cells_and_hide_columns(spark, tmp_path):
    ctx = annotated(spark)
    names = [fv.TITLE_COACH, fv.TITLE_FULL, fv.TITLE_SUMMARY, fv.TITLE_ACTION_TEXTS]
    paths, failures = registry.publish(ctx, str(tmp_path), names)
    assert not failures
    stored = {name: spark.read.parquet(path) for name, path in paths.items()}
    coach = stored[fv.TITLE_COACH]
    assert coach.columns == [h for h in fv.USER_HEADINGS.values() if h not in fv.HIDDEN_USER_COLUMNS] + [registry.CLASSES]
    for r in coach.collect():
        marks = r[registry.CLASSES]
        for column in ("User Onboarded", "Meal Log (3 days)", "Weight Log (7 days)"):
            assert (column in marks) == (r[column] != fv.YES), (column, r)
    full = stored[fv.TITLE_FULL].collect()
    assert any(r[registry.CLASSES].get("Goals Set") == fv.CELL_YELLOW for r in full if r["Goals Set"] == fv.NO) or not any(
        r["Goals Set"] == fv.NO for r in full
    )
    assert registry.CLASSES not in stored[fv.TITLE_SUMMARY].columns
    assert stored[fv.TITLE_ACTION_TEXTS].columns == list(fv.ACTION_HEADINGS.values())


def test_action_items_are_the_lists_row_by_row(spark):
    ctx = annotated(spark)
    lists = {(r["Consultant"], r["Action"]): r["Patients Pending"] for r in reports.report_actions_required(ctx).collect()}
    items: dict = {}
    for r in reports.report_action_items(ctx).collect():
        items.setdefault((r["Consultant"], r["Action"]), []).append(r["Patient Pending"])
    assert {k: ", ".join(v) for k, v in items.items()} == lists


def test_plan_names_are_excluded_in_any_case_but_with_their_spaces(spark):
    plans = [(1, "METABOLIC Screening", "GLP"), (2, " Metabolic Screening ", "GLP")]
    rows = {"patients": [patient(1), patient(2, active_subscription_id=2)], "subscriptions": plans}
    assert [r.id for r in filters.active_cohort(context(spark, rows), fv.GLP).collect()] == [2]


def test_no_list_of_consultants_means_all_of_them(spark):
    rows = {"patients": [patient(1), patient(2, nutritionist_id=77)], "subscriptions": PLANS}
    everyone = context(spark, rows, nutritionists=None)
    assert filters.active_cohort(everyone).count() == 2
    assert streaks.team_targets(everyone).count() == 2
    assert filters.active_cohort(context(spark, rows, nutritionists=())).count() == 0


def test_a_start_with_a_time_counts_by_its_day(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-30 10:00:00' AS subscription_start_date")
    assert df.filter(filters.started(dt.date(2024, 1, 30))).count() == 1
    assert df.filter(filters.started(dt.date(2024, 1, 29))).count() == 0


def test_annotated_users_touches_no_file_while_built(spark, folder, monkeypatch):
    """Its wide frame is not written while the query is built."""
    from cohortlane.plans import features as features_module
    from cohortlane.sources import sinks as sinks_module
    from cohortlane_checks.queries import make_context as checks_context

    def refuse(*_, **__):
        raise AssertionError("a file was written while a query was built")

    monkeypatch.setattr(features_module, "written_table", refuse)
    monkeypatch.setattr(sinks_module, "written_table", refuse)
    ctx = checks_context(spark, folder)
    from cohortlane.plans import reports as reports_module

    reports_module.report_annotated_users(ctx)
