"""Lead reports and the daily lead sync.

Every signup ends with exactly one outcome: ``filtered`` (an active customer's phone),
``rejected`` (no usable phone), ``exists`` (known lead, or a phone met earlier in the
same batch) or ``inserted``.  An unreadable active-customer table fails the job; it is
never taken for an empty one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..context import ReportContext
from ..functions.dates import on_day, shift_zone, tz_window
from ..functions.phones import normalize_phone, spread_blank
from ..functions.text import blank_to_null, full_name
from ..operators.filters import member_plans, with_reject_reason
from ..operators.joins import distinct_phones
from ..sources.sinks import append_table, as_text, check_columns, stored_columns, write_report, written_table


#: Partition column of the lead table: the signup day a run synced.
RUN_DAY = "run_day"


def report_contact_leads(ctx: ReportContext) -> DataFrame:
    rows = ctx.role("assistant").filter(on_day(F.col("created_at"), ctx.yesterday))
    return rows.select("*")


def signups(ctx: ReportContext) -> DataFrame:
    """Yesterday's signups, with the id that keeps them apart."""
    created = F.col("created_at")
    return ctx.role("patients").filter(tz_window(created, ctx.as_of, ctx.zone, ctx.window_mode)).select(
        "id",
        "phone",
        full_name(F.col("firstname"), F.col("middlename"), F.col("lastname")).alias("patient_name"),
        shift_zone(created, ctx.zone).alias("created_at_ist"),
        "email",
    )


def report_new_signups(ctx: ReportContext, with_email: bool = True) -> DataFrame:
    columns = ["phone", "patient_name", "created_at_ist", "email"]
    return signups(ctx).select(*(columns if with_email else columns[:-1]))


def active_customers(ctx: ReportContext) -> DataFrame:
    """Customers not to be contacted: no end-date and no plan-type test, unlike the cohorts."""
    return member_plans(ctx).filter(F.col("is_active") & (F.col("status") == fv.ACTIVE_STATUS))


def report_active_customers(ctx: ReportContext) -> DataFrame:
    return active_customers(ctx).select("phone")


def lead_fields(ctx: ReportContext) -> dict[str, Column]:
    signed_up = F.coalesce(F.date_format("created_at_ist", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))
    notes = F.concat(
        F.lit(fv.LEAD_NOTE.format(system=ctx.lead_system, time=f"{ctx.run_ts:%Y-%m-%d %H:%M:%S}")),
        signed_up,
    )
    return {
        "phone_number": F.col("phone_number"),
        "name": blank_to_null(F.col("patient_name")),
        "email": blank_to_null(F.col("email"), also=("null",)),
        "source": F.lit(ctx.lead_source),
        "sub_source": F.lit(fv.LEAD_SUB_SOURCE),
        "status": F.lit(fv.LEAD_STATUS),
        "notes": notes,
    }


def lead_record(checked: DataFrame, ctx: ReportContext) -> DataFrame:
    """Lead columns of rows that carry ``phone_number``, plus the record as JSON without its NULL fields."""
    fields = [c.alias(n) for n, c in lead_fields(ctx).items()]
    return checked.select("id", *fields).withColumn("lead", F.to_json(F.struct(*lead_fields(ctx))))


def phone_facts(checked: DataFrame, active: DataFrame, existing: DataFrame) -> DataFrame:
    """What is known per phone: active customer, known lead, first valid signup of the batch.

    One row per phone, aggregated on the map side.  Joining this single frame, instead
    of three, leaves the signups with one join that the skew join can split when one
    phone holds a large share of them.  The first signup is found among one day's
    signups alone; the aggregation over all phones then has flat columns and hashes.
    """
    valid = checked.filter("reject_reason IS NULL AND phone_key <> ''")
    first = valid.groupBy("phone_key").agg(F.min(F.struct("created_at_ist", "id"))["id"].alias("first_id"))
    branches = [
        distinct_phones(active).withColumn("is_customer", F.lit(True)),
        existing.filter("phone_key <> ''").select("phone_key", F.lit(True).alias("is_lead")),
        first,
    ]
    union = branches[0]
    for branch in branches[1:]:
        union = union.unionByName(branch, allowMissingColumns=True)
    return union.groupBy("phone_key").agg(
        F.max("is_customer").alias("is_customer"),
        F.max("is_lead").alias("is_lead"),
        F.max("first_id").alias("first_id"),
    )


def keyed_signups(rows: DataFrame) -> DataFrame:
    return with_reject_reason(rows).withColumn("phone_key", normalize_phone(F.col("phone")))


def sync_outcomes(rows: DataFrame, active: DataFrame, existing: DataFrame) -> DataFrame:
    """All signups with their outcome.  Blank phones match nothing and are spread over the tasks."""
    checked = keyed_signups(rows)
    facts = phone_facts(checked, active, existing).withColumnRenamed("phone_key", "join_key")
    joined = checked.withColumn("join_key", spread_blank(F.col("phone_key"), F.col("id"))).join(
        facts, "join_key", "left"
    )
    repeated = F.col("id") != F.col("first_id")
    outcome = (
        F.when(F.col("is_customer"), "filtered")
        .when(F.col("reject_reason").isNotNull(), "rejected")
        .when(F.coalesce("is_lead", F.lit(False)) | repeated, "exists")
        .otherwise("inserted")
    )
    return joined.withColumn("outcome", outcome).select(*checked.columns, "outcome")


def upsert_leads(leads: DataFrame, existing: DataFrame) -> DataFrame:
    """Outcome ``inserted`` or ``exists`` per valid lead; of equal phones the first signup is inserted."""
    none = leads.select("phone").filter(F.lit(False))
    return sync_outcomes(leads, none, existing).filter("outcome IN ('inserted', 'exists')")


def sync_stats(outcomes: DataFrame) -> DataFrame:
    """One row of counters; also one row (all zero) when there was nothing to do."""
    counts = {
        "total_fetched": F.count("*"),
        "active_customers_filtered": F.count_if(F.col("outcome") == "filtered"),
        "total_ingested": F.count_if(F.col("outcome") == "inserted"),
        "already_exists": F.count_if(F.col("outcome") == "exists"),
        "failed": F.count_if(F.col("outcome") == "rejected"),
    }
    return outcomes.agg(*[c.alias(n) for n, c in counts.items()]).withColumn(
        "success", F.expr("failed = 0 AND (total_ingested > 0 OR already_exists > 0 OR total_fetched = 0)")
    )


@dataclass(frozen=True)
class LeadSync:
    leads: DataFrame
    rejects: DataFrame
    outcomes: DataFrame
    stats: DataFrame

    def append_leads(self, path: str) -> None:
        append_table(self.leads.drop("id", "lead"), path)

    def commit_leads(self, path: str, run_day: dt.date, folder: str) -> None:
        """Replace the partition of ``run_day`` by what it held and this run's inserts.

        Idempotent: the partition is overwritten by dynamic partition overwrite, not appended
        to, so a rerun, a run that repeats one whose commit failed half way, and two runs
        that overlap all leave one row per phone.  Other days are never touched.  The rows
        are staged below ``folder`` first, since a job cannot overwrite what it reads.
        """
        spark = self.leads.sparkSession
        new = as_text(self.leads.drop("id", "lead")).withColumn(RUN_DAY, F.lit(run_day.isoformat()))
        stored = stored_columns(spark, path)
        check_columns(new.columns, stored, path)
        rows = new
        if stored is not None:
            held = spark.read.parquet(path).filter(F.col(RUN_DAY) == run_day.isoformat()).select(*new.columns)
            known = held.select(normalize_phone(F.col("phone_number")).alias("phone_key"))
            fresh = new.join(known, normalize_phone(F.col("phone_number")).eqNullSafe(F.col("phone_key")), "left_anti")
            rows = held.unionByName(fresh)
        staged = written_table(rows, folder, "day")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_DAY).parquet(path)


def lead_sync(ctx: ReportContext) -> LeadSync:
    outcomes = ctx.shared(
        "lead_outcomes",
        lambda: sync_outcomes(signups(ctx), active_customers(ctx), ctx.role("existing_leads")),
    )
    return LeadSync(
        leads=lead_record(outcomes.filter("outcome = 'inserted'"), ctx),
        rejects=outcomes.filter("outcome = 'rejected'").select("id", "phone", "reject_reason"),
        outcomes=outcomes,
        stats=sync_stats(outcomes),
    )


def known_leads(spark: SparkSession, path: str) -> DataFrame:
    """Phone keys of a lead table this module appends to; none when there is no table yet."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "phone_key STRING")
    return stored.select(normalize_phone(F.col("phone_number")).alias("phone_key")).distinct()


def prepare_lead_sync(ctx: ReportContext, lead_table: str, folder: str) -> LeadSync:
    """The run's outcomes against the leads the table holds now, written below ``folder``."""
    known = known_leads(ctx.spark, lead_table)
    outcomes = sync_outcomes(signups(ctx), active_customers(ctx), known)
    ctx = ctx.pinned({"lead_outcomes": written_table(outcomes, folder, "outcomes")})
    return lead_sync(ctx)


def run_lead_sync(ctx: ReportContext, lead_table: str, folder: str) -> LeadSync:
    """Sync into ``lead_table`` and keep rejects and statistics below ``folder``.

    The outcomes are written once and everything else is derived from them.  Known
    leads come from the table itself, so a repeated run finds its leads and adds none;
    the leads go in as the partition of the signup day (:meth:`LeadSync.commit_leads`).
    """
    sync = prepare_lead_sync(ctx, lead_table, folder)
    sync.commit_leads(lead_table, ctx.yesterday, folder)
    write_report(sync.rejects, folder, "rejects")
    write_report(sync.stats, folder, "stats")
    return sync
