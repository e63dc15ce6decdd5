"""Named reports in publishing order, and how a run of several of them is carried out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..context import ReportContext
from ..functions import rules
from ..operators.sets import concat_rows
from ..sources.sinks import append_table, describe_failure, drop_hidden, shared_folder, write_report, written_table
from . import features, leads, reports, streaks

Builder = Callable[[ReportContext], DataFrame]

USER_ANALYTICS: dict[str, Builder] = {
    fv.TITLE_SUMMARY: reports.report_summary_final,
    fv.TITLE_ACTIONS: reports.report_action_items,
    fv.TITLE_COACH: lambda ctx: reports.report_annotated_users(ctx, fv.COACH_APP),
    fv.TITLE_GLP: lambda ctx: reports.report_annotated_users(ctx, fv.GLP),
    fv.TITLE_FULL: reports.report_full_analytics,
}
LEADS: dict[str, Builder] = {
    fv.TITLE_CONTACT_LEADS: leads.report_contact_leads,
    fv.TITLE_SIGNUPS: lambda ctx: leads.report_new_signups(ctx, with_email=False),
}
TEAM: dict[str, Builder] = {fv.TITLE_STREAKS: streaks.report_team_streaks}
ALL: dict[str, Builder] = {**USER_ANALYTICS, **LEADS, **TEAM}
#: Not part of any flow; published where they are asked for by name.
EXTRAS: dict[str, Builder] = {fv.TITLE_ACTION_TEXTS: reports.report_actions_required}
KNOWN: dict[str, Builder] = {**ALL, **EXTRAS}

#: How published tables mark their cells.
FORMATS: dict[str, tuple[rules.Rule, ...]] = {
    fv.TITLE_COACH: rules.USER_RULES,
    fv.TITLE_GLP: rules.USER_RULES,
    fv.TITLE_FULL: rules.USER_RULES,
    fv.TITLE_STREAKS: rules.TEAM_RULES,
}
HIDDEN: dict[str, tuple[str, ...]] = {fv.TITLE_COACH: fv.HIDDEN_USER_COLUMNS, fv.TITLE_GLP: fv.HIDDEN_USER_COLUMNS}
CLASSES = "__cell_classes__"


def run_reports(ctx: ReportContext, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Lazy frames by heading, in order.  Several user reports share what :func:`pin` writes."""
    names = names or list(ALL)
    if sum(name in USER_ANALYTICS for name in names) > 1 and not ctx.holds("annotated"):
        ctx = pin(ctx)
    return {name: KNOWN[name](ctx) for name in names}


def scope_to(ctx: ReportContext, ids: DataFrame, folder: str) -> ReportContext:
    """Limit the facts of a run to the patients ``ids``, which are written once."""
    return replace(ctx, scope=written_table(ids.select("patient_id").distinct(), folder, "scope"))


def pin(ctx: ReportContext, folder: str | None = None) -> ReportContext:
    """Write the wide frame of the cohorts, which all user reports share, and the annotated users.

    Only the features are limited to the cohorts; the context itself stays without a
    scope, as a team report may follow other patients.
    """
    folder = folder or shared_folder(ctx.spark)
    scoped = scope_to(ctx, features.cohort_base(ctx), folder)
    rows = features.wide(scoped, prev=True, active=True)
    ctx = ctx.pinned({"wide": written_table(rows, folder, "wide")})
    return ctx.pinned({"annotated": written_table(reports.annotated_table(ctx), folder, "annotated")})


def published(df: DataFrame, heading: str) -> DataFrame:
    """The table as it is shown: without its hidden columns, with the class of each marked cell.

    ``__cell_classes__`` maps column to class; marks the rows carry already go before rules.
    """
    if heading not in FORMATS:
        return df
    shown = drop_hidden(df, HIDDEN.get(heading, ()))
    classes = rules.cell_classes(shown, FORMATS[heading])
    if CLASSES in df.columns:
        marks = F.col(CLASSES)
        by_rule = F.map_filter(classes, lambda column, _: ~F.map_contains_key(marks, column))
        classes = F.map_concat(by_rule, marks)
    return df.withColumn(CLASSES, classes).select(*[F.col(f"`{c}`") for c in shown.columns], CLASSES)


def publish(
    ctx: ReportContext, folder: str, names: list[str] | None = None, strict: bool = False
) -> tuple[dict[str, str], dict[str, str]]:
    """Write every report below ``folder``; returns the paths and the failures by heading.

    A failing report does not stop the others unless ``strict`` is set.
    """
    paths: dict[str, str] = {}
    failures: dict[str, str] = {}
    for name in names or list(ALL):
        try:
            paths[name] = write_report(published(KNOWN[name](ctx), name), folder, name)
        except Exception as error:  # one report must not take the run down
            if strict:
                raise
            failures[name] = describe_failure(error)
    return paths, failures


@dataclass(frozen=True)
class Flow:
    """Reports published together.  ``strict``: one failure stops the rest."""

    reports: dict[str, Builder]
    strict: bool = False


FLOWS = {
    "user_analytics": Flow(USER_ANALYTICS),
    "leads": Flow(LEADS, strict=True),
    "team": Flow(TEAM),
}


def run_flow(
    ctx: ReportContext, name: str, folder: str, signups_table: str | None = None
) -> tuple[dict[str, str], dict[str, str]]:
    """Publish one flow below ``folder``; the lead flow also appends its signups to a table."""
    flow = FLOWS[name]
    if name == "user_analytics":
        ctx = pin(ctx)
    if name == "team":
        ctx = scope_to(ctx, streaks.team_targets(ctx), shared_folder(ctx.spark))
    paths, failures = publish(ctx, folder, list(flow.reports), flow.strict)
    if signups_table and fv.TITLE_SIGNUPS in paths:
        append_table(ctx.spark.read.parquet(paths[fv.TITLE_SIGNUPS]), signups_table)
    return paths, failures


def contents(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per heading: its position, its rows, and a sum over its rows that any changed cell changes.

    ``content`` adds up the first 32 bits of an MD5 of each row's cells as text; order plays no part.
    """

    def digest(df: DataFrame) -> Column:
        cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in drop_hidden(df).columns]
        return F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("bigint")

    return concat_rows(
        *[
            df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(digest(df)), F.lit(0)).alias("content")).select(
                F.lit(i).alias("ordinal"), F.lit(name).alias("heading"), "n_rows", "content"
            )
            for i, (name, df) in enumerate(frames.items(), start=1)
        ]
    )


def published_contents(ctx: ReportContext, paths: dict[str, str]) -> DataFrame:
    return contents({name: ctx.spark.read.parquet(path) for name, path in paths.items()})

