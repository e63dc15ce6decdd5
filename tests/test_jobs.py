"""The daily jobs from role tables on disk to their results."""

from __future__ import annotations

import datetime as dt

import pytest

from cohortlane import fixed_values as fv
from cohortlane import jobs
from cohortlane.plans import leads, reports
from cohortlane.sources.roles import ROLE_SCHEMAS
from tests.fixtures import PLANS, at, context, patient, tables


@pytest.fixture(scope="module")
def roles(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("roles"))
    rows = {
        "patients": [
            patient(1, firstname="Ann"),
            patient(2, firstname="Bea", active_subscription_id=2),
            patient(3, is_active=False, phone="+91 90000-00077"),
            patient(4, is_active=False, phone="12"),
        ],
        "subscriptions": PLANS,
        "consultants": [(2, "Cleo")],
        "assistant": [(1, "call me", at(30))],
    }
    for role, df in tables(spark, rows).items():
        df.write.parquet(f"{folder}/{role}.parquet")
    return folder


def argv(job, roles, out, *more):
    return [job, "--roles", roles, "--out", str(out), "--as-of", "2024-01-31", "--nutritionists", "2,4", *more]


def test_user_analytics_with_a_csv_sheet(spark, roles, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text("Name,Meal logging reason\n ANN,Travelling\n")
    assert jobs.run(spark, argv("user_analytics", roles, tmp_path / "out", "--sheet", str(sheet)))
    coach = spark.read.parquet(str(tmp_path / "out" / "coach_app_user_analytics")).collect()
    assert [(r["Patient Name"], r["Meal Log (3 days)"]) for r in coach] == [("Ann", "Travelling")]
    actions = spark.read.parquet(str(tmp_path / "out" / "actions_required")).collect()
    meal = next(r for r in actions if r["Action"] == fv.ACTION_MEAL)
    assert meal["Patient Pending"] == "Bea"


def test_lead_flow_appends_its_signups(spark, roles, tmp_path):
    table = str(tmp_path / "signups")
    for _ in range(2):
        assert jobs.run(spark, argv("leads", roles, tmp_path / "out", "--signups-table", table))
    assert spark.read.parquet(table).count() == 2 * 4


def test_team_flow(spark, roles, tmp_path):
    assert jobs.run(spark, argv("team", roles, tmp_path / "out", "--team-phones", "9000000001,9000000002", "--team-leave-out", "bea test"))
    rows = spark.read.parquet(str(tmp_path / "out" / "team_streaks")).collect()
    assert [r["name"] for r in rows] == ["Ann Test"]


def test_lead_sync_can_be_repeated(spark, roles, tmp_path):
    table = str(tmp_path / "leads")
    for i, expected in enumerate([(1, 0), (0, 1)]):
        out = tmp_path / f"out{i}"
        assert not jobs.run(spark, argv("lead_sync", roles, out, "--lead-table", table))  # one reject
        stats = spark.read.parquet(str(out / "stats")).first()
        assert (stats.total_ingested, stats.already_exists) == expected
        assert (stats.total_fetched, stats.active_customers_filtered, stats.failed) == (4, 2, 1)
        assert spark.read.parquet(str(out / "rejects")).count() == 1
    stored = spark.read.parquet(table).collect()
    assert [(r.phone_number, r.status) for r in stored] == [("919000000077", "New")]


def test_lead_sync_needs_a_table():
    with pytest.raises(SystemExit):
        jobs.arguments(argv("lead_sync", "x", "y"))


def test_damaged_lead_table_is_not_taken_for_a_missing_one(spark, tmp_path):
    path = tmp_path / "leads"
    path.mkdir()
    (path / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        leads.known_leads(spark, str(path)).count()


def test_session_zone_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            context(spark, {})
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_progress_by_id_keeps_equal_names_apart(spark):
    rows = {
        "patients": [patient(1, firstname="Ann"), patient(2, firstname="Ann ")],
        "subscriptions": PLANS,
        "metrics": [(1, 1, "BODY_WEIGHT", 90.0, at(20), at(20)), (2, 2, "BODY_WEIGHT", 100.0, at(20), at(20))],
        "sheet": [(1, "ann", "", "2024-01-01", "", "")],
    }
    by_name, by_id = context(spark, rows), context(spark, rows, progress_key="id")
    got = [
        {r.patient_id: r.track for r in frame.collect()}
        for frame in (reports.annotated_track(by_name), reports.annotated_track(by_id), reports.annotated_table(by_id))
    ]
    assert got[0] == {1: fv.OFF_TRACK, 2: fv.OFF_TRACK}
    assert got[1] == got[2] == {1: fv.ON_TRACK, 2: fv.OFF_TRACK}


def test_run_day_is_an_argument(roles):
    args = jobs.arguments(argv("team", roles, "out"))
    assert args.as_of == dt.date(2024, 1, 31)


def test_roles_with_source_names_give_the_same_tables(spark, roles, tmp_path):
    """The job over tables whose columns are named as the source names them."""
    names = {"created_at": "createdAt", "is_active": "isActive", "messaged_at": "messagedAt"}
    for role in ROLE_SCHEMAS:
        df = spark.read.parquet(f"{roles}/{role}.parquet").withColumnsRenamed(names)
        df.write.parquet(f"{tmp_path}/source/{role}.parquet")
    for folder, out in ((roles, "a"), (str(tmp_path / "source"), "b")):
        assert jobs.run(spark, argv("user_analytics", folder, tmp_path / out))
    for table in ("full_analytics", "actions_required", "coach_app_user_analytics"):
        a, b = (spark.read.parquet(str(tmp_path / out / table)) for out in ("a", "b"))
        assert a.count() > 0 and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_team_from_a_table(spark, roles, tmp_path):
    spark.createDataFrame([("9000000001",), ("9000000002",)], "phone STRING").write.parquet(str(tmp_path / "team"))
    assert jobs.run(spark, argv("team", roles, tmp_path / "out", "--team-table", str(tmp_path / "team")))
    assert spark.read.parquet(str(tmp_path / "out" / "team_streaks")).count() == 2
