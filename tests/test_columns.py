"""Edge cases of the column functions on literals."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlane import fixed_values as fv
from cohortlane.functions import dates, measures, phones, rules, text


def evaluate(spark, values, kind, build):
    """``build`` applied to each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i INT, v {kind}")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_normalize_phone(spark):
    cases = {
        None: "",
        "": "",
        "--": "",
        "9000000001": "9000000001",
        "+919000000001": "9000000001",
        "+91 90000-00001": "9000000001",
        "(90000) 00001": "9000000001",
        "919000000001": "9000000001",
        "9190000000": "9190000000",
        "12345": "12345",
        "009190000 00001": "9000000001",
        "\t+91 9000000001 ": "9000000001",
        "+91": "",
    }
    assert evaluate(spark, cases, "STRING", phones.normalize_phone) == list(cases.values())


def test_digits_only_keeps_country_code(spark):
    values = [None, "", "+91 90000-00001", "abc", "(90000) 00001"]
    assert evaluate(spark, values, "STRING", phones.digits_only) == ["", "", "919000000001", "", "9000000001"]


def test_spread_blank_moves_only_blank_keys(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, "").otherwise("9000000001"))
    keys = df.select(phones.spread_blank(F.col("k"), F.col("id")).alias("k"), "id")
    assert keys.filter("id < 900").select("k").distinct().count() > 500
    assert keys.filter("id < 900 AND k NOT LIKE '~%'").count() == 0
    assert keys.filter("id >= 900 AND k <> '9000000001'").count() == 0


def test_blank_to_null(spark):
    values = [None, " ", "\t", "null", "NULL", " a@b.test \n"]
    also = evaluate(spark, values, "STRING", lambda c: text.blank_to_null(c, also=("null",)))
    assert also == [None, None, None, None, None, "a@b.test"]
    assert evaluate(spark, values, "STRING", text.blank_to_null)[3:] == ["null", "NULL", "a@b.test"]


def test_normalize_name_strips_all_white_space(spark):
    values = [" Ann  ", "\tANN\n", "  ", None, "An n"]
    assert evaluate(spark, values, "STRING", text.normalize_name) == ["ann", "ann", None, None, "an n"]


def test_parse_date_multi(spark):
    cases = {
        "2024-01-05": dt.date(2024, 1, 5),
        "2024-1-5": dt.date(2024, 1, 5),
        "05-01-2024": dt.date(2024, 1, 5),
        "5/1/2024": dt.date(2024, 1, 5),
        "05/11/2025": dt.date(2025, 11, 5),
        "13/01/2024": dt.date(2024, 1, 13),
        "01/13/2024": dt.date(2024, 1, 13),
        "5 Jan 2024": dt.date(2024, 1, 5),
        "5  jan 2024": dt.date(2024, 1, 5),
        "5 January 2024": dt.date(2024, 1, 5),
        "7 May 2024": dt.date(2024, 5, 7),
        "2024/01/05": dt.date(2024, 1, 5),
        "2024-01-05T10:00:00": dt.date(2024, 1, 5),
        " 2024-01-05 23:59:59.5+05:30 ": dt.date(2024, 1, 5),
        "20240105": dt.date(2024, 1, 5),
        "31-02-2024": None,
        "2024-01-05T25:00:00": None,
        "n/a": None,
        "": None,
        None: None,
    }
    assert evaluate(spark, cases, "STRING", dates.parse_date_multi) == list(cases.values())


def test_parse_float(spark):
    cases = {
        " 70.5 ": 70.5,
        "1e3": 1000.0,
        "1_000": 1000.0,
        "-.5": -0.5,
        "5.": 5.0,
        "5d": None,
        "12kg": None,
        "1__0": None,
        "": None,
        None: None,
        "inf": math.inf,
    }
    assert evaluate(spark, cases, "STRING", text.parse_float) == list(cases.values())
    assert math.isnan(evaluate(spark, ["nan"], "STRING", text.parse_float)[0])


def test_round2_is_decimal_half_away_from_zero(spark):
    values = [1.005, -1.005, 2.675, 70.125, None]
    assert evaluate(spark, values, "DOUBLE", measures.round2) == [1.01, -1.01, 2.68, 70.13, None]


@pytest.mark.parametrize(
    ("start", "goal", "duration", "start_day", "current", "expected"),
    [
        (None, 80.0, 90, 1, 95.0, fv.DATA_INCOMPLETE),
        (100.0, None, 90, 1, 95.0, fv.DATA_INCOMPLETE),
        (100.0, 80.0, None, 1, 95.0, fv.DATA_INCOMPLETE),
        (100.0, 80.0, 0, 1, 95.0, fv.DATA_INCOMPLETE),
        (100.0, 80.0, 90, None, 95.0, fv.DATA_INCOMPLETE),
        (100.0, 80.0, 90, 1, None, fv.DATA_INCOMPLETE),
        (80.0, 80.0, 90, 1, 80.0, fv.GOAL_ACHIEVED),
        (100.0, 70.0, 30, 1, 70.0, fv.ON_TRACK),  # 30 days at 1 per day: exactly reached
        (100.0, 70.0, 30, 1, 70.5, fv.OFF_TRACK),
        (100.0, 70.0, 30, 60, 100.0, fv.ON_TRACK),  # starts in the future: nothing expected yet
    ],
)
def test_track_status(spark, start, goal, duration, start_day, current, expected):
    day = None if start_day is None else dt.date(2024, 1, 1) + dt.timedelta(days=start_day - 1)
    schema = "s DOUBLE, g DOUBLE, d INT, day DATE, c DOUBLE"
    df = spark.createDataFrame([(start, goal, duration, day, current)], schema)
    days = F.datediff(dates.day(dt.date(2024, 1, 31)), F.col("day"))
    status = measures.track_status(*[F.col(c) for c in ("s", "g", "d", "day", "c")], days)
    assert df.select(status).first()[0] == expected


@pytest.mark.parametrize(
    ("start", "goal", "current", "reported", "dose", "expected"),
    [
        (100.0, 91.0, 95.0, None, "2024-01-01", fv.ON_TRACK),
        (100.0, 91.0, 98.0, None, "2024-01-01", fv.OFF_TRACK),
        (100.0, 91.0, None, 5.0, "2024-01-01", fv.ON_TRACK),  # falls back to the reported loss
        (100.0, 91.0, None, None, "2024-01-01", fv.DATA_INCOMPLETE),
        (100.0, 91.0, 95.0, None, None, fv.DATA_INCOMPLETE),
        (100.0, 91.0, 100.0, None, "2024-03-01", fv.ON_TRACK),  # future dose: nothing expected yet
        (100.0, 100.0, 95.0, None, "2024-01-01", fv.DATA_INCOMPLETE),
        (None, 91.0, 95.0, None, "2024-01-01", fv.DATA_INCOMPLETE),
    ],
)
def test_progress_status(spark, start, goal, current, reported, dose, expected):
    df = spark.createDataFrame(
        [(start, goal, current, reported, dose)], "s DOUBLE, g DOUBLE, c DOUBLE, r DOUBLE, dose STRING"
    )
    columns = [F.col(c) for c in ("s", "g", "c", "r")]
    status = measures.progress_status(*columns, F.col("dose").cast("date"), dates.day(dt.date(2024, 1, 31)))
    assert df.select(status).first()[0] == expected


def test_inactivity_reason_all_combinations(spark):
    flags = [(i, bool(i & 4), bool(i & 2), bool(i & 1)) for i in range(8)]
    df = spark.createDataFrame(flags, "i INT, f BOOLEAN, h BOOLEAN, a BOOLEAN")
    got = [
        r.out
        for r in df.select("i", text.inactivity_reason(F.col("f"), F.col("h"), F.col("a")).alias("out"))
        .orderBy("i")
        .collect()
    ]
    for (_, food, habit, activity), reason in zip(flags, got, strict=True):
        missing = [
            t
            for present, t in ((food, fv.MISSING_MEAL), (habit, fv.MISSING_HABIT), (activity, fv.MISSING_ACTIVITY))
            if not present
        ]
        assert reason == (", ".join(missing) or fv.ACTIVE_TEXT)


def test_names(spark):
    rows = [("Ann", None, "Lee"), (" Ann ", "Mid", ""), (None, "", "Lee"), (None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, f STRING, m STRING, l STRING")
    f, m, last = F.col("f"), F.col("m"), F.col("l")
    got = df.select("i", text.full_name(f, m, last).alias("full"), text.short_name(f, last).alias("short"))
    got = got.orderBy("i").collect()
    assert [r.full for r in got] == ["Ann Lee", "Ann  Mid", "Lee", ""]
    assert [r.short for r in got] == ["Ann Lee", " Ann  ", " Lee", " "]


def test_signed_and_days_label(spark):
    assert evaluate(spark, [3, 0, -2, None], "INT", text.signed) == ["+3", "+0", "-2", None]
    label = evaluate(spark, [1, 2, 12, None], "INT", lambda c: text.days_label(F.lit("Ann"), c))
    assert label == [None, "Ann (2 days)", "Ann (12 days)", None]


def test_reason_override(spark):
    df = spark.createDataFrame(
        [("No", "Travel"), ("no ", ""), ("Yes", "Travel"), ("No", None)], "v STRING, r STRING"
    )
    got = [r[0] for r in df.select(text.reason_override(F.col("v"), F.col("r"))).collect()]
    assert got == ["Travel", "no ", "Yes", "No"]


def test_tz_bounds():
    as_of = dt.date(2024, 1, 31)
    assert dates.tz_bounds(as_of, "Asia/Kolkata") == (
        dt.datetime(2024, 1, 30, 5, 30),
        dt.datetime(2024, 1, 31, 5, 30),
    )
    assert dates.tz_bounds(as_of, "Asia/Kolkata", "local_day") == (
        dt.datetime(2024, 1, 29, 18, 30),
        dt.datetime(2024, 1, 30, 18, 30),
    )


def test_not_in_normalised_drops_null(spark):
    df = spark.createDataFrame([(" Alpha ",), ("beta",), (None,)], "v STRING")
    kept = df.filter(text.not_in_normalised(F.col("v"), ("ALPHA",))).collect()
    assert [r.v for r in kept] == ["beta"]


def test_json_cell_keeps_null_fields(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', CAST(NULL AS STRING)) AS v, CAST(NULL AS INT) AS n")
    nested = text.json_cell(F.col("v"), df.schema["v"].dataType)
    row = df.select(nested.alias("v"), text.json_cell(F.col("n"), T.IntegerType()).alias("n")).first()
    assert row.v == '{"a":1,"b":null}'
    assert row.n == ""


def test_format_rules_match_names_exactly(spark):
    df = spark.createDataFrame(
        [(1, "no", 5, "x", "off track"), (2, "Yes", 2, "-0.5", "Off Track"), (3, " No ", 1, "0", "-"), (4, None, None, None, None)],
        "id INT, `User Onboarded` STRING, `Days Since Last Interaction` INT, "
        "`Current Weight Lose` STRING, `OnTrack/OffTrack` STRING",
    )
    got = {(r.id, r.column_name): r.cell_class for r in rules.format_rules(df, ["id"]).collect()}
    assert got == {
        (1, "User Onboarded"): "bg-red",
        (1, "Days Since Last Interaction"): "bg-red",
        (2, "Days Since Last Interaction"): "bg-yellow",
        (2, "Current Weight Lose"): "bg-red",
        (3, "User Onboarded"): "bg-red",
    }
    shown = df.withColumnRenamed("OnTrack/OffTrack", "On/Off Track")
    orange = [r.id for r in rules.format_rules(shown, ["id"]).filter("cell_class = 'bg-orange'").collect()]
    assert sorted(orange) == [1, 2]
    assert df.select(F.size(rules.cell_classes(df.select("id")))).first()[0] == 0


def test_days_on_which_clocks_change_have_their_own_bounds(spark):
    """Europe/Berlin went from +1 to +2 hours on 2024-03-31 and back on 2024-10-27."""
    for as_of, lower, upper in (
        (dt.date(2024, 4, 1), dt.datetime(2024, 3, 30, 23), dt.datetime(2024, 3, 31, 22)),
        (dt.date(2024, 10, 28), dt.datetime(2024, 10, 26, 22), dt.datetime(2024, 10, 27, 23)),
    ):
        assert dates.tz_bounds(as_of, "Europe/Berlin", "local_day") == (lower, upper)
    times = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-03-31 00:30:00'), (TIMESTAMP '2024-03-31 01:30:00') AS t(c)")
    shown = [r[0] for r in times.orderBy("c").select(dates.shift_zone(F.col("c"), "Europe/Berlin")).collect()]
    assert shown == [dt.datetime(2024, 3, 31, 1, 30), dt.datetime(2024, 3, 31, 3, 30)]


def test_no_value_and_no_text_is_cut(spark):
    long = "+91" + "x" * (1 << 20) + "9000000001"
    assert evaluate(spark, [long], "STRING", phones.normalize_phone) == ["9000000001"]
    rounded = evaluate(spark, [1e30, float("inf"), 2.345, None], "DOUBLE", measures.round2)
    assert rounded == [1e30, float("inf"), 2.35, None]
