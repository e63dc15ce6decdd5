"""Reading sheets and role tables, writing reports."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlane import ReportContext
from cohortlane.functions.text import normalise_columns
from cohortlane.operators.joins import sheet_lookup
from cohortlane.plans import leads, reports
from cohortlane.sources import sinks
from cohortlane.sources.roles import ROLE_SCHEMAS, folder_reader, snake_columns
from cohortlane.sources.sheet import read_sheet, sheet_role
from tests.fixtures import PLANS, at, context, patient, tables


def write(tmp_path, lines):
    path = tmp_path / "sheet.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_ragged_rows_and_row_order(spark, tmp_path):
    path = write(
        tmp_path,
        [
            "Patient Name,Not onboarding reason,GLP 1ST DOSE ,Meal logging reason,Weight logging reason",
            "Ann,No scale,2024-01-05,,",
            "Bob",
            " ANN ,Second entry,\"5 Jan, 2024\",Travelling",
            "Cid,a,b,c,d,more,cells",
        ],
    )
    sheet = read_sheet(spark, path)
    rows = sheet.orderBy("row_no").collect()
    assert [r["Patient Name"] for r in rows] == ["Ann", "Bob", " ANN ", "Cid"]
    assert list(rows[1][:5]) == ["Bob", "", "", "", ""]
    assert rows[2]["Weight logging reason"] == ""
    role = sheet_role(sheet)
    assert role.columns == [c.split()[0] for c in ROLE_SCHEMAS["sheet"].split(", ")]
    last = {r.name_key: r for r in sheet_lookup(role).collect()}
    assert last["ann"].not_onboarding_reason == "Second entry"
    assert last["ann"].glp_1st_dose == "5 Jan, 2024"


def test_name_falls_back_row_by_row(spark, tmp_path):
    path = write(tmp_path, ["Name,Patient Name,Weight Logging Reason", "Ann,,x", "Bob,Bobby,y", ",,z"])
    role = sheet_role(read_sheet(spark, path)).orderBy("row_no").collect()
    assert [r.name for r in role] == ["Ann", "Bobby", None]
    assert [r.weight_logging_reason for r in role] == ["x", "y", "z"]
    assert role[0].glp_1st_dose is None


def test_normalise_columns_last_of_equal_names_wins(spark):
    df = spark.sql("SELECT 'a' AS ` Name`, 'b' AS `name `, 'c' AS Other")
    got = normalise_columns(df)
    assert got.columns == ["name", "other"]
    assert got.first() == ("b", "c")


def test_cells_with_line_breaks_and_quotes_stay_whole(spark, tmp_path):
    path = write(
        tmp_path,
        [
            "Name,Not onboarding reason,Meal logging reason",
            'Ann,"line one\nline two",x',
            'Bob,"said ""no"" twice, ok",y',
            "Cid,,z",
        ],
    )
    rows = sheet_role(read_sheet(spark, path)).orderBy("row_no").collect()
    assert [r.name for r in rows] == ["Ann", "Bob", "Cid"]
    assert [r.not_onboarding_reason for r in rows] == ["line one\nline two", 'said "no" twice, ok', ""]
    assert [r.meal_logging_reason for r in rows] == ["x", "y", "z"]


def test_large_sheet_of_several_files_keeps_its_order(spark, tmp_path):
    """Later files are smaller, so that the order of reading is not the order of their names."""
    path = str(tmp_path / "sheets")
    (tmp_path / "sheets").mkdir()
    at = 0
    for n, size in enumerate((30_000, 20_000, 9_000, 1_000)):
        lines = [f"P{i % 1000},reason {i}" for i in range(at, at + size)]
        (tmp_path / "sheets" / f"part-{n}.csv").write_text("\n".join(["Name,Not onboarding reason", *lines]) + "\n")
        at += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        sheet = read_sheet(spark, path)
        assert sheet.rdd.getNumPartitions() > 1
        last = sheet_lookup(sheet_role(sheet))
        assert last.count() == 1000
        wrong = last.filter(
            F.col("not_onboarding_reason") != F.concat(F.lit("reason "), (F.substring("name_key", 2, 9).cast("int") + 59_000).cast("string"))
        )
        assert wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_append_table_is_text_and_accepts_empty_frames(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.sql("SELECT 1 AS n, CAST(NULL AS STRING) AS s, named_struct('k', array(1, 2)) AS j, true AS b")
    sinks.append_table(df, path)
    sinks.append_table(df.filter("n > 5"), path)
    sinks.append_table(df, path)
    stored = spark.read.parquet(path)
    assert stored.dtypes == [(c, "string") for c in ("n", "s", "j", "b")]
    assert stored.collect() == [("1", "", '{"k":[1,2]}', "true")] * 2


def test_append_to_nothing_keeps_the_columns(spark, tmp_path):
    path = str(tmp_path / "none")
    sinks.append_table(spark.sql("SELECT 1 AS n WHERE false"), path)
    assert spark.read.parquet(path).columns == ["n"]


def test_drop_hidden(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS `__row_class__`, 3 AS `b c`, 4 AS d")
    assert sinks.drop_hidden(df, ("d",)).columns == ["a", "b c"]


def test_shared_folder_follows_the_session(spark):
    class Session:
        def __init__(self, **values):
            self.values = {k.replace("_", "."): v for k, v in values.items()}

        @property
        def conf(self):
            return self.values

    named = Session(spark_checkpoint_dir="hdfs://shared/dir/", spark_sql_warehouse_dir="hdfs://house")
    first, second = sinks.shared_folder(named), sinks.shared_folder(named)
    assert first.startswith("hdfs://shared/dir/cohortlane-") and first != second
    unnamed = Session(spark_sql_warehouse_dir="hdfs://house")
    assert sinks.shared_folder(unnamed).startswith("hdfs://house/cohortlane-")
    assert sinks.shared_folder(spark) != sinks.shared_folder(spark)


def test_written_reports_can_be_read_back(spark, tmp_path):
    ctx = context(spark, {"patients": [patient(1)], "subscriptions": PLANS})
    frames = {"Full Analytics": reports.report_full_analytics(ctx), "New Signups": leads.report_new_signups(ctx)}
    paths = sinks.write_reports(frames, str(tmp_path))
    for name, path in paths.items():
        stored = spark.read.parquet(path)
        assert stored.columns == frames[name].columns
        assert sorted(map(str, stored.collect())) == sorted(map(str, frames[name].collect()))


def test_role_folder(spark, tmp_path):
    rows = {
        "patients": [patient(1), patient(2, active_subscription_id=2)],
        "subscriptions": PLANS,
        "metrics": [(1, 1, "BODY_WEIGHT", 90.0, at(20), at(20))],
        "assistant": [(1, "hello", at(30)), (2, "late", at(31))],
    }
    frames = tables(spark, rows)
    for role, df in frames.items():
        df.write.parquet(f"{tmp_path}/{role}.parquet")
    ctx = ReportContext(
        spark=spark, read=folder_reader(spark, str(tmp_path)), as_of=dt.date(2024, 1, 31), nutritionists=(2,),
        run_ts=dt.datetime(2024, 1, 31, 6),
    )
    memory = context(spark, rows, nutritionists=(2,))
    stored, direct = (reports.full_table(c).orderBy("patient_id").collect() for c in (ctx, memory))
    assert stored == direct
    assert [r.id for r in leads.report_contact_leads(ctx).collect()] == [1]


def test_source_names_become_snake_case(spark):
    df = spark.sql("SELECT 1 AS id, true AS isActive, 2 AS createdAt, 3 AS messagedAt")
    assert snake_columns(df).columns == ["id", "is_active", "created_at", "messaged_at"]


def test_roles_are_read_under_the_source_names(spark, tmp_path):
    """As the source has them: camel-case names, and columns of other types and more than asked for."""
    spark.sql("SELECT 1L AS chat_id, 2 AS sender, TIMESTAMP '2024-01-30 10:00:00' AS messagedAt, 'x' AS more").write.parquet(
        f"{tmp_path}/messages.parquet"
    )
    read = folder_reader(spark, str(tmp_path))("messages")
    assert read.dtypes == [("chat_id", "bigint"), ("sender", "bigint"), ("messaged_at", "timestamp")]
    assert read.first().messaged_at == dt.datetime(2024, 1, 30, 10)


def test_an_absent_column_is_an_error(spark, tmp_path):
    spark.sql("SELECT 1L AS chat_id, 2L AS sender").write.parquet(f"{tmp_path}/messages.parquet")
    with pytest.raises(ValueError, match="messaged_at"):
        folder_reader(spark, str(tmp_path))("messages")
