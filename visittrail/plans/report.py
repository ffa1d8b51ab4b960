"""The visit report: all branches of a study joined into one wide row per visit or plan."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visittrail.fixed_values import (
    CANCELED,
    COMPLETED,
    FINAL_DAYS,
    FIRST_SUBMISSION_DAYS,
    NO_PLAN,
    PLAN_STATUS_NAMES,
    PLANNED,
    REPORT_COLUMNS,
    VISIT_TYPE_NAMES,
)
from visittrail.functions import (
    clean_text,
    decode,
    elapsed_days,
    period_label,
    protocol_alias,
    visit_length,
)
from visittrail.operators.approvals import approval_steps, complete_approvals, step_chain
from visittrail.operators.counted import COUNT
from visittrail.operators.issues import data_issues, process_issues
from visittrail.operators.plans import plan_flags, plan_monitors_agg, plan_site_links
from visittrail.operators.reconcile import distinct_plan_visits, plan_visit_rows
from visittrail.operators.sites import report_sites
from visittrail.operators.visits import visit_flags, visit_summary, with_stage_dates
from visittrail.schema import STUDY
from visittrail.sources.studies import StudyTables


def visit_report(
    tables: StudyTables, as_of: datetime.date, aliases: DataFrame | None = None
) -> DataFrame:
    """The report of one study.

    Project names come from the fixed list, or from (protocol, alias) rows when given.
    """
    # Joins by slot alone, which can be split on a slot that holds many rows.
    reconciled = plan_visit_rows(
        plans_with_monitors(tables), distinct_visits(tables, as_of), plan_flags(tables.plan))
    return _reported(reconciled, tables, as_of, aliases).drop(STUDY)


def studies_report(
    tables: StudyTables, as_of: datetime.date, aliases: DataFrame | None = None
) -> DataFrame:
    """The report of several studies in one job, the study prefix in front."""
    reconciled = distinct_plan_visits(plans_with_monitors(tables), distinct_visits(tables, as_of))
    return _reported(reconciled, tables, as_of, aliases)


def _reported(
    reconciled: DataFrame, tables: StudyTables, as_of: datetime.date, aliases: DataFrame | None
) -> DataFrame:
    rows = shown_rows(with_day_counts(reconciled), as_of)
    sites = report_sites(tables.site, tables.sites, tables.study)
    joined = rows.join(sites, [STUDY, "docid"], "left")
    named = (
        joined.withColumn("gp_pn", protocol_alias(F.col("protocolnumber")))
        if aliases is None else with_alias(joined, aliases)
    )
    return named.select(STUDY, *REPORT_COLUMNS).distinct()


def with_alias(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """Project name by protocol from a list of at most one alias each."""
    names = aliases.select(F.col("protocol").alias("protocolnumber"), F.col("alias").alias("gp_pn"))
    return rows.join(names, "protocolnumber", "left")


def plans_with_monitors(tables: StudyTables) -> DataFrame:
    return plan_monitors_agg(
        plan_flags(tables.plan), plan_site_links(tables.link), tables.site
    )


def distinct_visits(tables: StudyTables, as_of: datetime.date) -> DataFrame:
    """Validated visits, each distinct row once."""
    approvals = complete_approvals(tables.mv)
    chain = step_chain(approvals)
    summary = visit_summary(approval_steps(approvals, chain, as_of))
    return visit_flags(with_stage_dates(summary).drop(COUNT)).distinct()


def with_day_counts(rows: DataFrame) -> DataFrame:
    """Days between the milestones of a visit."""
    start, end = F.col("mvdat"), F.col("mvendat")
    first, reject = F.col("first_submission"), F.col("latest_rejection")
    approve = F.col("approval_date")
    return rows.withColumns({
        "calc_mv_len": visit_length(start, end),
        "calc_mv_2_submit": elapsed_days(end, first, count_start=False),
        "calc_submit_2_reject": elapsed_days(first, reject, count_start=True),
        "calc_mv_2_approve": elapsed_days(end, approve, count_start=False),
        "calc_submit_2_approve": elapsed_days(first, approve, count_start=True),
    })


def shown_rows(rows: DataFrame, as_of: datetime.date) -> DataFrame:
    status = F.col("planmvstat")
    shown = {
        "id": F.lit(None).cast("string"),
        "plans_supported": F.lit("Yes"),
        "planmvtyp": decode(F.col("planmvtyp"), VISIT_TYPE_NAMES),
        "planmvstat": status_name(status),
        "submission_round": F.coalesce("submission_round", F.lit(0)),
        "rejection_round": F.coalesce("rejection_round", F.lit(0)),
        "reviewername": clean_text(F.col("reviewername")),
        "current_stage": shown_stage(status, F.col("current_stage")),
        "stage": F.coalesce("stage", F.lit("NA")),
        "data_issues": data_issues(),
        "process_issues": process_issues(as_of),
        "period_planned_visit": period_label(F.col("planmvendat")),
        "period_performed_visit": period_label(F.col("mvendat")),
        "planned_visit": planned_visit(status),
        "performed_visit": performed_visit(status),
        "first_submission_on_time": on_time(F.col("calc_mv_2_submit"), FIRST_SUBMISSION_DAYS),
        "finalization_on_time": on_time(F.col("calc_mv_2_approve"), FINAL_DAYS),
    }
    from_site = {"protocolnumber", "gp_pn", "country", "siteid"}
    return rows.select(
        STUDY, "docid",
        *(shown.get(c, F.col(c)).alias(c) for c in REPORT_COLUMNS if c not in from_site),
    )


def status_name(status: Column) -> Column:
    return F.when(status.isNull(), NO_PLAN).otherwise(decode(status, PLAN_STATUS_NAMES))


def shown_stage(status: Column, stage: Column) -> Column:
    """Stage of the visit, left out while it is only planned or was cancelled."""
    return F.when(status.isin(PLANNED, CANCELED), None).otherwise(stage)


def planned_visit(status: Column) -> Column:
    return F.when(status == PLANNED, 1)


def performed_visit(status: Column) -> Column:
    return F.when((status == COMPLETED) | status.isNull(), 1)


def on_time(days: Column, limit: int) -> Column:
    return (days <= limit).cast("int")
