"""One registered query per operator and report, over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlane import ReportContext
from cohortlane import fixed_values as fv
from cohortlane.functions import dates, measures, phones, rules, text
from cohortlane.operators import aggregates, filters, joins, sets, windows
from cohortlane.plans import features, leads, registry, reports, streaks
from cohortlane.sources import sheet as sheets
from cohortlane.sources import sinks

from .standins import standin_reader

AS_OF = dt.date(2024, 1, 31)
STREAK_START = dt.date(2024, 1, 5)
RUN_TS = dt.datetime(2024, 1, 31, 6, 0, 0)
NUTRITIONISTS = (2, 4, 6)
PLANS_LEFT_OUT = ("nation_3", " Nation_7 ")
TEAM_LEFT_OUT = ("customer#000000008  household", "Customer#000000020  BUILDING ")

Query = Callable[[ReportContext], DataFrame]
QUERIES: dict[str, Query] = {}


def make_context(spark: SparkSession, folder: str) -> ReportContext:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return ReportContext(
        spark=spark,
        read=standin_reader(spark, folder),
        as_of=AS_OF,
        nutritionists=NUTRITIONISTS,
        streak_start=STREAK_START,
        run_ts=RUN_TS,
        team_excluded_names=TEAM_LEFT_OUT,
    )


def followed(ctx: ReportContext) -> ReportContext:
    """With the whole patients table as the team, so that its report grows with the data."""
    return replace(ctx, team_phones=ctx.role("patients").select("phone").filter("phone IS NOT NULL"))


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def ts(c: str) -> Column:
    return F.col(c).cast("timestamp").alias(c)


def on_day_column(c: str) -> Column:
    return F.to_date(c).alias("day")


# --- scans, sources, sinks ----------------------------------------------------


@query
def scan_role(ctx):
    return ctx.role("patients")


@query
def report_registry(ctx):
    return registry.contents(registry.run_reports(followed(ctx)))


@query
def sheet_source(ctx):
    """The sheet written as CSV files and read as a sheet; its own numbers come back as a column."""
    cells = ctx.role("sheet")
    headed = cells.select("row_no", "name", *[F.col(c).alias(h) for c, h in fv.SHEET_REASON_HEADERS.items()])
    path = f"{sinks.shared_folder(ctx.spark)}/sheet"
    headed.withColumnRenamed("row_no", "No").write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    read = sheets.read_sheet(ctx.spark, path)
    numbers = read.select("row_no", F.col("No").cast("bigint").alias("own"))
    role = sheets.sheet_role(read).withColumn("name", F.coalesce("name", F.lit("")))
    return role.join(numbers, "row_no").drop("row_no").withColumnRenamed("own", "row_no")


@query
def append_sink(ctx):
    """Appended twice to a new table, and an empty frame in between."""
    rows = leads.signups(ctx).withColumn("contact", F.struct("phone", "email"))
    path = f"{sinks.shared_folder(ctx.spark)}/signups"
    for part in (rows, rows.filter(F.lit(False)), rows):
        sinks.append_table(part, path)
    return ctx.spark.read.parquet(path)


@query
def lead_upsert(ctx):
    done = leads.upsert_leads(leads.signups(ctx), ctx.role("existing_leads"))
    return done.select("id", "phone_key", "outcome")


@query
def report_output(ctx):
    pinned = registry.pin(followed(ctx))
    paths, failures = registry.publish(pinned, sinks.shared_folder(ctx.spark))
    if failures:
        raise RuntimeError(f"reports failed: {failures}")
    return registry.published_contents(ctx, paths)


@query
def select_star(ctx):
    return ctx.role("assistant").select("*").withColumn("created_at", ts("created_at"))


@query
def drop_columns(ctx):
    rows = ctx.role("patients").select("id", "phone", "email", "status")
    return sinks.drop_hidden(rows.withColumn("__row_class__", F.lit("even")), ("email",))


# --- filters ------------------------------------------------------------------


@query
def active_cohort(ctx):
    return filters.active_cohort(ctx).select("id", "cohort", "plan_name", "nutritionist_id")


@query
def started_by(ctx):
    started = filters.active_cohort(ctx, started_by=ctx.yesterday)
    return started.select("id", "cohort", "subscription_start_date")


@query
def in_list(ctx):
    chosen = filters.in_list(F.col("nutritionist_id"), NUTRITIONISTS)
    return ctx.role("patients").filter(chosen).select("id", "nutritionist_id")


@query
def not_in_normalised(ctx):
    kept = text.not_in_normalised(F.col("plan_name"), PLANS_LEFT_OUT)
    return filters.member_plans(ctx).filter(kept).select("id", "plan_name")


@query
def non_blank(ctx):
    return ctx.role("patients").filter(text.non_blank(F.col("firstname"))).select("id", "firstname")


@query
def on_day(ctx):
    rows = ctx.role("assistant").filter(dates.on_day(F.col("created_at"), ctx.yesterday))
    return rows.select("id", ts("created_at"))


@query
def tz_day_window(ctx):
    patients, created = ctx.role("patients"), F.col("created_at")
    frames = []
    for mode in ("literal", "local_day"):
        hit = dates.tz_window(created, ctx.as_of, ctx.zone, mode)
        frames.append(patients.filter(hit).select("id", F.lit(mode).alias("mode"), "created_at"))
    return sets.concat_rows(*frames)


def lookback_rows(ctx: ReportContext, as_of: dt.date, until: dt.date | None) -> DataFrame:
    meals = ctx.role("patientfoodlogs").filter(dates.lookback(F.col("date"), as_of, 3, until))
    weights = filters.body_weights(ctx.role("metrics"))
    weights = weights.filter(dates.lookback(F.col("date"), as_of, 7, until))
    return sets.concat_rows(
        meals.select(F.lit("meal").alias("source"), "patient_id", ts("date")),
        weights.select(F.lit("weight").alias("source"), "patient_id", ts("date")),
    )


@query
def lookback_open(ctx):
    return lookback_rows(ctx, ctx.as_of, None)


@query
def lookback_bounded(ctx):
    return lookback_rows(ctx, ctx.yesterday, ctx.as_of)


@query
def between_days(ctx):
    week = dates.between_days(F.col("date"), ctx.days_back(7), ctx.yesterday)
    rows = filters.body_weights(ctx.role("metrics")).filter(week)
    return rows.select("patient_id", "event_id", on_day_column("date"))


@query
def as_of_cutoff(ctx):
    return ctx.role("messages").filter(dates.before_day(F.col("messaged_at"), ctx.as_of))


@query
def equality_filters(ctx):
    own = ctx.role("patientsideeffects").filter(F.col("creator") == fv.REPORTED_BY_PATIENT)
    rows = {
        "body_fat": filters.body_fats(ctx.role("metrics")),
        "appointment": filters.done_appointments(ctx.role("appointment")),
        "side_effect": own,
    }
    return sets.concat_rows(
        *[
            df.select(F.lit(source).alias("source"), "patient_id", on_day_column("date"))
            for source, df in rows.items()
        ]
    )


@query
def side_effect_filter(ctx):
    return filters.severe_side_effects(ctx).select("patient_id", "type", ts("date"))


@query
def valid_lead_split(ctx):
    valid, rejects = filters.split_valid(leads.signups(ctx))
    both = sets.concat_rows(valid, rejects)
    return both.select("id", "phone", "phone_number", "reject_reason")


@query
def row_number_eq_1(ctx):
    latest = windows.first_ranked(
        filters.body_weights(ctx.role("metrics")), ["patient_id"], *windows.WEIGHT_ORDER
    )
    return latest.select("patient_id", "event_id", "value")


# --- joins --------------------------------------------------------------------


@query
def join_subscription(ctx):
    joined = joins.join_subscription(ctx.role("patients"), ctx.role("subscriptions"))
    return joined.select("id", "active_subscription_id", "plan_name", "plan_type")


@query
def join_consultant(ctx):
    joined = joins.join_consultant(ctx.role("patients"), ctx.role("consultants"))
    return joined.select("id", "nutritionist_id", "consultant_name")


@query
def chat_message_join(ctx):
    return joins.chat_message_join(ctx.role("chats"), ctx.role("messages"))


@query
def exists_flag(ctx):
    base = ctx.role("patients").select(F.col("id").alias("patient_id"))
    metrics, meals = ctx.role("metrics"), ctx.role("patientfoodlogs")
    flagged = joins.exists_flag(base, metrics, "patient_id", "has_fat", F.col("name") == fv.BODY_FAT)
    return joins.exists_flag(flagged, meals, "patient_id", "has_food")


def spine(ctx: ReportContext) -> DataFrame:
    base = ctx.role("patients").select(F.col("id").alias("patient_id"))
    return joins.cross_dates(base, sets.spine_start(ctx), ctx.yesterday)


@query
def exists_by_day(ctx):
    return joins.exists_by_day(spine(ctx), streaks.log_tables(ctx), F.col("date").isNotNull())


@query
def cross_join_lateral(ctx):
    return spine(ctx)


@query
def feature_left_joins(ctx):
    joined = joins.join_features(
        features.cohort_base(ctx),
        [features.engagement(ctx), features.weights(ctx), features.recent_active_days(ctx)],
    )
    return joined.select(
        "patient_id",
        "cohort",
        features.last_contact().alias("last_contact"),
        "last_meal_day",
        "last_weight_day",
        "current_weight",
        "active_days",
    )


@query
def status_inner_join(ctx):
    targets = streaks.team_targets(followed(ctx))
    day_rows = joins.cross_dates(targets.select("patient_id"), ctx.yesterday, ctx.yesterday)
    only = dates.on_day(F.col("date"), ctx.yesterday)
    status = joins.exists_by_day(day_rows, streaks.log_tables(ctx), only)
    return targets.join(status, "patient_id")


def streak_active_days(ctx: ReportContext) -> DataFrame:
    return streaks.daily_logs(ctx).filter(measures.active_streak(F.col("food"), F.col("activity")))


@query
def island_self_join(ctx):
    return windows.current_streak(streak_active_days(ctx), ctx.yesterday, ctx.streak_start)


@query
def active_customer_anti_join(ctx):
    kept = joins.anti_join_phones(leads.signups(ctx), leads.active_customers(ctx))
    return kept.select("id", "phone", "phone_key")


def doubled_sheet(ctx: ReportContext) -> DataFrame:
    """Every seventh sheet row entered again further down with another reason."""
    sheet = ctx.role("sheet")
    again = sheet.filter("row_no % 7 = 0").withColumns(
        {
            "row_no": F.col("row_no") + F.lit(1 << 40),
            "name": F.upper("name"),
            "not_onboarding_reason": F.lit("Entered twice"),
        }
    )
    return sheet.unionByName(again)


@query
def sheet_lookup_join(ctx):
    users = ctx.role("patients").select("id", "firstname")
    joined = joins.lookup_join(users, "firstname", joins.sheet_lookup(doubled_sheet(ctx)))
    return joined.select("id", "not_onboarding_reason", "glp_1st_dose", "meal_logging_reason")


@query
def analytics_lookup_join(ctx):
    users = features.cohort_base(ctx).select("patient_id", F.trim("firstname").alias("user_name"))
    lookup = reports.analytics_lookup(reports.progress_inputs(ctx))
    return joins.lookup_join(users, "user_name", lookup)


@query
def scalar_subquery(ctx):
    coach, glp = F.col("cohort") == fv.COACH_APP, F.col("cohort") == fv.GLP
    return filters.active_cohort(ctx).agg(
        F.count_if(coach).alias("coach_today"),
        F.count_if(coach & filters.started(ctx.yesterday)).alias("coach_yesterday"),
        F.count_if(glp).alias("glp_today"),
        F.count_if(glp & filters.started(ctx.yesterday)).alias("glp_yesterday"),
    )


# --- aggregations -------------------------------------------------------------


@query
def last_date(ctx):
    return features.engagement(ctx, active=True).select(
        "patient_id",
        features.last_contact().alias("last_contact"),
        "last_visit_day",
        "last_message_day",
        "last_meal_day",
        "last_weight_day",
        "last_active_day",
    )


@query
def days_since_last(ctx):
    e = features.engagement(ctx, prev=True)
    return e.select(
        "patient_id",
        dates.day_diff(dates.day(ctx.as_of), features.last_contact()).alias("days_today"),
        dates.day_diff(dates.day(ctx.yesterday), features.last_contact("last_note_day_prev")).alias("days_named"),
        dates.day_diff(dates.day(ctx.yesterday), features.last_contact("last_any_note_day_prev")).alias("days_any"),
    ).filter("days_today IS NOT NULL OR days_any IS NOT NULL")


@query
def presence_group(ctx):
    meals = aggregates.present_since(ctx.role("patientfoodlogs"), "date", ctx.as_of, 3, "logged")
    weights = aggregates.present_since(
        filters.body_weights(ctx.role("metrics")), "date", ctx.as_of, 7, "logged"
    )
    return sets.concat_rows(
        meals.withColumn("source", F.lit("meal")), weights.withColumn("source", F.lit("weight"))
    )


@query
def count_gt_zero(ctx):
    return streaks.weight_logged(ctx)


@query
def string_agg(ctx):
    return features.side_effect_texts(ctx)


@query
def count_distinct_case(ctx):
    return features.recent_active_days(ctx)


@query
def count_filter(ctx):
    names = ("n_users", "n_not_onboarded", "n_on_track", "n_off_track", "n_no_contact", "n_no_meal", "n_no_weight")
    conds = aggregates.summary_conditions().values()
    return aggregates.conditional_counts(
        features.summary_features(ctx), ["cohort"], dict(zip(names, conds, strict=True))
    )


@query
def summary_matrix(ctx):
    return aggregates.summary_matrix(features.summary_features(ctx))


@query
def summary_delta(ctx):
    return reports.summary_table(ctx)


@query
def track_recount(ctx):
    return aggregates.recount(reports.summary_table(ctx), reports.annotated_table(ctx))


@query
def count_star(ctx):
    logs = sets.concat_rows(
        *[df.select(F.lit(n).alias("source"), "patient_id") for n, df in streaks.log_tables(ctx).items()]
    )
    return aggregates.count_rows(logs, "source", "patient_id")


@query
def distinct_phones(ctx):
    return joins.distinct_phones(leads.active_customers(ctx))


@query
def sync_stats(ctx):
    return leads.lead_sync(ctx).stats


@query
def consultant_actions(ctx):
    """Over the users as queried, before any sheet reason is put in."""
    return aggregates.consultant_actions(reports.user_flags(ctx))


# --- windows ------------------------------------------------------------------


@query
def latest_weight(ctx):
    return windows.latest_weight(ctx.role("metrics"))


@query
def latest_weight_as_of(ctx):
    return windows.latest_weight(ctx.role("metrics"), ctx.yesterday)


@query
def latest_in_window(ctx):
    weights = filters.body_weights(ctx.role("metrics"))
    return aggregates.present_since(weights, "date", ctx.as_of, 7, "logged_in_last_7_days")


@query
def latest_note(ctx):
    return windows.latest_note(ctx.role("patientnotes"))


@query
def gaps_islands(ctx):
    logs = joins.exists_by_day(spine(ctx), streaks.log_tables(ctx), F.col("date").isNotNull())
    flagged = logs.select(
        "patient_id",
        "check_date",
        measures.active_streak(F.col("food"), F.col("activity")).alias("is_active"),
    )
    return windows.islands(flagged, "patient_id", "check_date", "is_active")


@query
def current_streak(ctx):
    marks = windows.streak_marks(streaks.daily_logs(ctx), ctx.yesterday, ctx.streak_start)
    base = ctx.role("patients").select(F.col("id").alias("patient_id"))
    joined = joins.join_features(base, [marks])
    return joined.select("patient_id", F.coalesce("streak", F.lit(0)).alias("streak"))


# --- sorts --------------------------------------------------------------------


@query
def sort_hidden_key(ctx):
    return sets.sorted_report(reports.summary_table(ctx), ["sort_order"], drop=("sort_order",))


@query
def sort_two_keys(ctx):
    columns = ["cohort", "patient_name", "start_weight", "current_weight", "patient_id"]
    rows = reports.progress_inputs(ctx).select(*columns)
    return sets.sorted_report(rows, ["cohort", "patient_name", "patient_id"], drop=("patient_id",))


@query
def sort_name(ctx):
    return sets.sorted_report(streaks.team_targets(followed(ctx)), ["name", "patient_id"])


@query
def sort_in_group(ctx):
    users = features.cohort_base(ctx).select("nutritionist_id", F.trim("firstname").alias("patient_name"))
    lists = aggregates.long_text(users, ["nutritionist_id"], "patient_name", "patients")
    return sets.sorted_report(lists, ["nutritionist_id"])


# --- set operations and generators --------------------------------------------


@query
def interaction_union_all(ctx):
    return sets.interactions(ctx)


@query
def activity_union_distinct(ctx):
    return sets.activity_days(ctx)


@query
def cohort_union_all(ctx):
    return sets.all_cohorts(ctx).select("id", "cohort")


@query
def metric_rows_union(ctx):
    return aggregates.metric_rows(aggregates.summary_matrix(features.summary_features(ctx)))


@query
def detail_concat(ctx):
    coach, glp = reports.user_flags(ctx, fv.COACH_APP), reports.user_flags(ctx, fv.GLP)
    return sets.concat_rows(coach, glp).select("patient_id", "cohort", "patient_name", "consultant_name")


@query
def date_spine(ctx):
    """All days of the spine with their number of activity rows, also those without any."""
    days = sets.date_spine(ctx.spark, sets.spine_start(ctx), ctx.yesterday)
    rows = ctx.role("activity").groupBy(F.to_date("date").alias("check_date")).agg(F.count("*").alias("n"))
    return days.join(rows, "check_date", "left").select("check_date", F.coalesce("n", F.lit(0)).alias("n_rows"))


# --- scalar functions ---------------------------------------------------------


def start_days(ctx: ReportContext) -> Column:
    return dates.day_diff(dates.day(ctx.as_of), F.col("subscription_start_date"))


@query
def day_diff(ctx):
    return ctx.role("patients").select("id", start_days(ctx).alias("days"))


@query
def greatest_dates(ctx):
    created = F.when(F.col("start_weight").isNotNull(), F.to_date("created_at"))
    start = F.when(F.col("is_active"), F.col("subscription_start_date"))
    return ctx.role("patients").select(
        "id",
        dates.latest_of(created, start, F.lit(None).cast("date")).alias("latest"),
        F.greatest(F.lit(0), start_days(ctx) - 15).alias("days_from_15"),
        F.least("subscription_start_date", dates.day(ctx.days_back(10))).alias("earliest"),
    )


@query
def safe_divide(ctx):
    per_day = measures.safe_div(F.col("start_weight") - F.col("goal_weight"), F.col("target_duration"))
    return ctx.role("patients").select("id", per_day.alias("per_day"))


@query
def round2(ctx):
    return ctx.role("metrics").select("event_id", measures.round2(F.col("value")).alias("value"))


@query
def track_status_sql(ctx):
    return features.summary_features(ctx).select("patient_id", "cohort", "track", "track_prev")


@query
def onboarded_flag(ctx):
    return features.summary_features(ctx).select("patient_id", "user_onboarded", "user_onboarded_prev")


@query
def expected_actual_loss(ctx):
    return reports.full_table(ctx).select("patient_id", "expected_loss", "actual_loss")


@query
def yes_no(ctx):
    return ctx.role("patients").select(
        "id",
        text.yes_no(F.col("start_weight") > 90).alias("heavy"),
        F.coalesce("middlename", F.lit(fv.NONE_TEXT)).alias("middle"),
        F.coalesce("target_duration", F.lit(0)).alias("duration"),
    )


@query
def full_name(ctx):
    first, middle, last = (F.col(c) for c in ("firstname", "middlename", "lastname"))
    return ctx.role("patients").select(
        "id",
        text.full_name(first, middle, last).alias("full_name"),
        text.short_name(first, last).alias("short_name"),
    )


@query
def inactivity_reason(ctx):
    return streaks.team_streaks(followed(ctx)).select("patient_id", "reason")


@query
def active_definitions(ctx):
    food, habit, activity = (F.col(c) for c in streaks.LOG_ROLES)
    return streaks.daily_logs(ctx).select(
        "patient_id",
        "check_date",
        measures.active_strict(food, habit, activity).alias("strict"),
        measures.active_streak(food, activity).alias("streak_active"),
    )


@query
def signed_text(ctx):
    return ctx.role("patients").select("id", text.signed(start_days(ctx) - 15).alias("change"))


@query
def ist_shift(ctx):
    shifted = dates.shift_zone(F.col("created_at"), ctx.zone)
    return ctx.role("patients").select("id", shifted.alias("created_at_ist"))


@query
def normalize_phone(ctx):
    return ctx.role("patients").select("id", phones.normalize_phone(F.col("phone")).alias("phone_key"))


@query
def digits_only(ctx):
    return ctx.role("patients").select("id", phones.digits_only(F.col("phone")).alias("phone_number"))


@query
def blank_to_null(ctx):
    return ctx.role("patients").select(
        "id",
        text.blank_to_null(F.col("email"), also=("null",)).alias("email"),
        text.blank_to_null(F.col("firstname")).alias("firstname"),
    )


@query
def lead_record(ctx):
    valid, _ = filters.split_valid(leads.signups(ctx))
    return leads.lead_record(valid, ctx)


@query
def normalize_name(ctx):
    return ctx.role("sheet").select("row_no", text.normalize_name(F.col("name")).alias("name_key"))


@query
def column_ci(ctx):
    sheet = ctx.role("sheet").select(
        "row_no",
        F.col("name").alias(" Patient NAME "),
        F.col("glp_1st_dose").alias("GLP 1st Dose"),
        F.col("meal_logging_reason").alias("meal logging REASON "),
    )
    return text.normalise_columns(sheet)


def number_texts(start: Column, row: Column) -> Column:
    """Number texts of several shapes made from the start weight."""
    plain = start.cast("string")
    return (
        F.when(row % 6 == 0, F.concat(F.lit(" "), plain, F.lit(" ")))
        .when(row % 6 == 1, F.concat(plain, F.lit("e1")))
        .when(row % 6 == 2, F.concat(plain, F.lit("d")))
        .when(row % 6 == 3, F.concat(plain, F.lit("kg")))
        .when(row % 6 == 4, F.lit(""))
        .otherwise(F.concat(F.lit("-"), plain))
    )


@query
def parse_float(ctx):
    texts = number_texts(F.col("start_weight"), F.col("id"))
    return ctx.role("patients").select("id", text.parse_float(texts).alias("number"))


@query
def parse_date_multi(ctx):
    return ctx.role("sheet").select("row_no", dates.parse_date_multi(F.col("glp_1st_dose")).alias("dose_day"))


@query
def progress_status(ctx):
    return reports.annotated_track(ctx).select("patient_id", "track")


@query
def reason_override(ctx):
    return reports.annotated_flags(ctx).select("patient_id", "user_onboarded", "meal_log", "weight_log")


@query
def format_rules(ctx):
    full = reports.full_table(ctx)
    shown = full.select(
        "patient_id", *[F.col(c).alias(h) for c, h in fv.FULL_HEADINGS.items() if c != "patient_name"]
    )
    users = rules.format_rules(shown, ["patient_id"])
    team = streaks.team_streaks(followed(ctx)).select(
        "patient_id", *[F.col(c).alias(h) for c, h in fv.STREAK_HEADINGS.items() if c != "name"]
    )
    return sets.concat_rows(users, rules.format_rules(team, ["patient_id"], rules.TEAM_RULES))


@query
def json_cell(ctx):
    contact = T.StructType().add("phone", T.StringType()).add("plan", T.IntegerType())
    return ctx.role("patients").select(
        "id",
        text.json_cell(F.struct("phone", F.col("active_subscription_id").alias("plan")), contact).alias("contact"),
        text.json_cell(F.array("middlename", "status"), T.ArrayType(T.StringType())).alias("words"),
        text.json_cell(F.col("email"), T.StringType()).alias("email"),
        text.json_cell(F.col("target_duration"), T.IntegerType()).alias("duration"),
    )


@query
def days_label(ctx):
    users = reports.user_flags(ctx)
    label = text.days_label(F.col("patient_name"), F.col("days_since_contact"))
    return users.select("patient_id", label.alias("label"))


@query
def trim_alias(ctx):
    return ctx.role("patients").select("id", text.trim_alias(F.col("firstname"), "Patient Name"))


# --- reports ------------------------------------------------------------------


@query
def summary_comparison(ctx):
    return reports.report_summary_comparison(ctx)


@query
def coach_app_users(ctx):
    return reports.report_coach_app_users(ctx)


@query
def glp_users(ctx):
    return reports.report_glp_users(ctx)


@query
def full_analytics(ctx):
    return reports.report_full_analytics(ctx)


@query
def team_streaks(ctx):
    return reports.titled(streaks.team_streaks(followed(ctx)), {"patient_id": "patient_id", **fv.STREAK_HEADINGS})


@query
def contact_leads(ctx):
    return leads.report_contact_leads(ctx).withColumn("created_at", ts("created_at"))


@query
def new_signups(ctx):
    return leads.report_new_signups(ctx)


@query
def active_customers(ctx):
    return leads.report_active_customers(ctx)


@query
def annotated_users(ctx):
    users = reports.report_annotated_users(ctx)
    return users.withColumn("__cell_classes__", F.to_json("__cell_classes__"))


@query
def summary_final(ctx):
    return reports.report_summary_final(ctx)


@query
def actions_required(ctx):
    return reports.report_actions_required(ctx)


@query
def action_items(ctx):
    return reports.report_action_items(ctx)


@query
def published_cells(ctx):
    """Marked cells of the user tables as they are published, without the columns they hide."""
    frames = []
    for heading, build in registry.USER_ANALYTICS.items():
        if heading in registry.FORMATS:
            shown = registry.published(build(ctx), heading)
            cells = shown.select(F.lit(heading).alias("heading"), F.explode(registry.CLASSES).alias("column_name", "cell_class"))
            frames.append(cells.withColumn("n_columns", F.lit(len(shown.columns) - 1)))
    every = sets.concat_rows(*frames)
    return every.groupBy(*every.columns).agg(F.count("*").alias("n_cells"))


@query
def lead_sync(ctx):
    return leads.lead_sync(ctx).outcomes


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query):
        return lambda spark, folder: build(make_context(spark, folder))

    return {name: bind(build) for name, build in QUERIES.items()}
