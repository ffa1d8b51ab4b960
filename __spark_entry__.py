
from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle.checks import CHECKS
from visittrail import functions as V
from visittrail.fixed_values import (
    PROCESS_LIMITS,
    REPORT_COLUMNS,
    STAGE_ISSUES,
    STAGE_LETTERS,
    VISIT_TYPE_NAMES,
)
from visittrail.operators import approvals, plans, reconcile, sites, visits
from visittrail.operators.counted import COUNT, expanded, once, summed
from visittrail.functions.sql import register_functions
from visittrail.plans import database, discovery, report
from visittrail.schema import STUDY, TABLE_COLUMNS
from visittrail.session import configure, new_folder
from visittrail.sources import studies, warehouse
from visittrail.sources.catalog import catalog_listing, listed_columns, plain_names
from visittrail.sources.warehouse import AS_OF

try:
    import corpus_pipeline
    from visittrail.llm import registry
except ImportError:
    registry = None

VISIT = visits.VISIT[1:]


class Study:
    """The stages of the report over the driver's tables, each built when first asked for."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = configure(spark), path

    @cached_property
    def tables(self):
        return warehouse.warehouse_study(self.spark, self.path)

    @cached_property
    def stored(self):
        return studies.stored_study(self.tables, new_folder(self.spark, "study"))

    @cached_property
    def plans(self):
        return plans.plan_flags(self.tables.plan)

    @cached_property
    def links(self):
        return plans.plan_site_links(self.tables.link)

    @cached_property
    def plan_agg(self):
        return report.plans_with_monitors(self.tables)

    @cached_property
    def approvals(self):
        return approvals.complete_approvals(self.tables.mv)

    @cached_property
    def facts(self):
        return approvals.approval_facts(self.approvals, AS_OF)

    @cached_property
    def summarized(self):
        chain = approvals.step_chain(self.approvals)
        return visits.visit_summary(approvals.approval_steps(self.approvals, chain, AS_OF))

    @cached_property
    def summary(self):
        return visits.visit_rows(self.summarized)

    @cached_property
    def submitted(self):
        return visits.submissions(self.facts)

    @cached_property
    def rejected(self):
        return visits.rejections(self.facts)

    @cached_property
    def staged(self):
        return visits.with_stage_dates(self.summarized)

    @cached_property
    def checked(self):
        return visits.counted_visit_flags(self.staged)

    @cached_property
    def reconciled(self):
        t = self.stored
        return reconcile.distinct_plan_visits(
            report.plans_with_monitors(t), report.distinct_visits(t, AS_OF))

    @cached_property
    def counted(self):
        return report.with_day_counts(self.reconciled)

    @cached_property
    def shown(self):
        return report.shown_rows(self.counted, AS_OF)

    @cached_property
    def directory(self):
        t = self.tables
        return sites.site_directory(t.site, t.sites, t.study)

    @cached_property
    def catalog_tables(self):
        return warehouse.table_rows(self.spark, self.path)

    @cached_property
    def catalog_columns(self):
        return warehouse.column_rows(self.spark, self.path)

    @cached_property
    def counts(self):
        return discovery.layout_counts(self.catalog_tables, self.catalog_columns)


    @cached_property
    def database(self):
        """Name of a database of stored studies with tables of every layout."""
        folder = new_folder(self.spark, "database")
        name = folder.rsplit("/", 1)[1].replace("-", "_")
        return warehouse.stored_database(self.spark, self.path, folder, name)

    @cached_property
    def reported(self):
        return database.database_report(self.spark, self.database, AS_OF)


QUERIES: dict[str, Callable[[Study], DataFrame]] = {}


def query(build: Callable[[Study], DataFrame]) -> Callable[[Study], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def _scan(kind: str) -> Callable[[Study], DataFrame]:
    return lambda s: getattr(s.tables, kind).select(*TABLE_COLUMNS[kind])


QUERIES |= {
    "scan_plan": _scan("plan"),
    "scan_approvals": _scan("mv"),
    "scan_site": _scan("site"),
    "scan_site_labels": _scan("sites"),
    "scan_study": _scan("study"),
    "scan_link": _scan("link"),
}


@query
def catalog_tables(s):
    return plain_names(discovery.study_tables(s.catalog_tables).select("table_name", "kind"))


@query
def catalog_columns(s):
    return plain_names(s.catalog_columns)


@query
def catalog_prefixes(s):
    return discovery.catalog_prefixes(s.catalog_tables)


@query
def layout_counts(s):
    return s.counts.select("prefix", "mv_cols", "mv_dayid", "mv_mvdate2")


@query
def layout_matrix(s):
    return s.counts


@query
def layout_classify(s):
    return discovery.layout_classify(s.counts)


@query
def complete_plans(s):
    return plans.complete_rows(s.tables.plan).select(*TABLE_COLUMNS["plan"][:-1])


@query
def plan_site_links(s):
    return s.links.drop(STUDY)


@query
def performed_visits(s):
    return visits.performed_visits(s.summary).select(*VISIT, "mvperf", "mvdat", "mvendat")


@query
def submissions(s):
    return s.submitted.drop(STUDY)


@query
def rejections(s):
    return s.rejected.drop(STUDY)


@query
def weekend_flags(s):
    day = F.col("planmvdat")
    return s.tables.plan.select(
        "planspid", "planmvdat", F.dayofweek(day).alias("weekday"),
        F.when(V.is_weekend(day), 1).alias("is_weekend"),
    )


@query
def decode_codes(s):
    codes = s.tables.mv.select(
        "visitid", "approvalstage",
        V.decode(F.col("approvalstage"), STAGE_LETTERS).alias("stage"),
        V.decode(F.col("visitid"), VISIT_TYPE_NAMES).alias("visit_type"),
    )
    return codes.groupBy(*codes.columns).agg(F.count(F.lit(1)).alias("n"))


@query
def plan_flags(s):
    return s.plans.drop(STUDY)


@query
def plan_duration_check(s):
    start, end = F.col("planmvdat"), F.col("planmvendat")
    return s.plans.select(
        "planspid", "planmvdat", "planmvendat", "planmvdurat",
        (F.datediff(end, start) + 1).alias("calendar_days"),
        V.weekdays_between(end, start).alias("weekdays"),
        "data_issue_incorrect_plan_durat",
    )


@query
def current_stage(s):
    return s.summary.select(*VISIT, "stage", V.latest_stage(F.col("stage")).alias("current_stage"))


@query
def stage_order_check(s):
    wrong = F.when(V.is_bad_stage_order(F.col("stage")), 1)
    return s.summary.select(*VISIT, "stage", wrong.alias("data_issue_wrong_stage_order"))


@query
def report_defaults(s):
    return s.shown.select("docid", "mvseq", "mvdat", "submission_round", "rejection_round", "stage")


@query
def report_stage(s):
    status = F.col("planmvstat")
    return s.counted.select(
        "docid", "planspid", "planmvstat", "current_stage",
        report.shown_stage(status, F.col("current_stage")).alias("shown_stage"),
    )


@query
def protocol_alias(s):
    fixed = s.tables.study.select(
        "docid", F.col("studyid").alias("protocolnumber"),
        V.protocol_alias(F.col("studyid")).alias("fixed_alias"),
    )
    given = report.with_alias(fixed, warehouse.alias_rows(s.spark, s.path))
    return given.select("docid", "protocolnumber", "fixed_alias", "gp_pn")


@query
def plan_links(s):
    return plans.plan_links(s.plans, s.links).select(
        "docid", "planspid", "countryid", "siteid_t", "countryid_t", "sitemonseq_t"
    )


@query
def plan_monitors(s):
    return plans.plan_monitors(s.plans, s.links, s.tables.site).drop(STUDY)


@query
def plan_monitors_agg(s):
    return s.plan_agg.drop(STUDY)


@query
def monitor_name(s):
    name = V.monitor_name(F.col("sitemonfirst"), F.col("sitemonlast"))
    return s.tables.site.select("docid", "siteid", name.alias("monitor_name"))


@query
def next_approval(s):
    return approvals.next_approval(s.approvals).drop(STUDY)


@query
def next_approval_date(s):
    return approvals.next_approval_date(s.approvals, AS_OF).drop(STUDY)


@query
def open_stage_age(s):
    last = approvals.next_approval(s.approvals).filter(F.col("next_approval_id").isNull())
    still_open = last.withColumn("next_date", approvals.next_date(F.lit(False), F.lit(None), AS_OF))
    return still_open.filter(F.col("next_date").isNotNull()).select(
        *VISIT, "approvalid", "approvaldat", "next_date",
        F.datediff("next_date", "approvaldat").alias("open_days"),
    )


@query
def approval_facts(s):
    return s.facts.drop(STUDY)


@query
def submission_duration(s):
    return s.facts.filter(F.col("stage") == "S").select(
        *VISIT, "approvalid", "approvaldat", "next_date", "submission_duration"
    )


@query
def rejection_duration(s):
    return s.facts.filter(F.col("stage") == "R").select(
        *VISIT, "approvalid", "approvaldat", "next_date", "rejection_duration"
    )


@query
def durations(s):
    days = ["calc_mv_len", *(c for c, _, _ in PROCESS_LIMITS if c.startswith("calc"))]
    return s.counted.select("docid", "planspid", "mvdat", "mvendat", *days)


@query
def visit_summary(s):
    return s.summary.drop(STUDY)


@query
def visit_names(s):
    return s.summary.select(
        *VISIT, "mvrepname", "submitter_name", "stagesubmittorname", "approvalname",
        "reviewername",
    )


@query
def stage_sequence(s):
    return s.summary.select(*VISIT, "stage")


@query
def stage_date_pairs(s):
    return s.summary.select(*VISIT, "submission_next", "reject_submit")


@query
def visit_rounds(s):
    return s.summary.select(*VISIT, "submission_round", "rejection_round")


@query
def visit_issue_counts(s):
    return s.summary.select(*VISIT, *STAGE_ISSUES)


@query
def review_time(s):
    return s.summary.select(*VISIT, "total_submit_len")


@query
def author_time(s):
    return s.summary.select(*VISIT, "total_cra_time")


@query
def visit_first_submission(s):
    return expanded(visits.with_first_submission(once(s.summarized))).select(
        *VISIT, "first_submission_approvalid", "first_submission"
    )


@query
def visit_last_submission(s):
    return expanded(visits.with_last_submission(once(s.summarized))).select(
        *VISIT, "latest_submission_approvalid", "latest_submission", "last_submit_len"
    )


@query
def visit_last_rejection(s):
    return expanded(visits.with_last_rejection(once(s.summarized))).select(
        *VISIT, "latest_rejection_approvalid", "latest_rejection", "last_reject_len"
    )


@query
def visit_stage_dates(s):
    return expanded(s.staged).drop(STUDY)


@query
def visit_flags(s):
    return expanded(s.checked).drop(STUDY)


@query
def plan_left_visit(s):
    return expanded(reconcile.counted_left_visit(s.plan_agg, s.checked)).drop(STUDY)


@query
def plan_right_visit(s):
    return expanded(reconcile.counted_right_visit(s.plan_agg, s.checked)).drop(STUDY)


@query
def completed_missing_visit(s):
    days = visits.performed_visits(visits.visit_days(s.approvals))
    lost = reconcile.completed_without_visit(plans.distinct_plans(s.plans), days)
    return lost.select("docid", "countryid", "planspid", "planmvdat", "planmvstat")


@query
def plan_visit_reconcile(s):
    return s.reconciled.drop(STUDY)


@query
def site_country(s):
    return sites.site_country(s.tables.site, s.tables.sites).select(
        "docid", "siteid", "countryid", "country"
    )


@query
def site_directory(s):
    return s.directory.drop(STUDY)


@query
def clean_text(s):
    return s.tables.site.select(
        "docid", "siteid", V.clean_text(F.col("siteid")).alias("site"),
        V.clean_text(F.col("sitemonfirst")).alias("first_name"),
    )


@query
def week_start(s):
    return s.tables.plan.select(
        "planspid", "planmvdat", V.week_start(F.col("planmvdat")).alias("week_start")
    )


@query
def weekdays_between(s):
    start, end = F.col("planmvdat"), F.col("planmvendat")
    return s.tables.plan.select(
        "planspid", "planmvdat", "planmvendat", V.weekdays_between(start, end).alias("weekdays"),
        V.weekdays_between(end, start).alias("weekdays_back"),
    )


@query
def period_label(s):
    return s.tables.plan.select(
        "planspid", V.period_label(F.col("planmvendat")).alias("period_planned_visit")
    )


def _day_count(name: str) -> Callable[[Study], DataFrame]:
    return lambda s: s.counted.select(
        "docid", "planspid", "mvdat", "mvendat", "first_submission", "latest_rejection",
        "approval_date", name,
    )


QUERIES |= {
    name: _day_count(name)
    for name in (
        "calc_mv_len", "calc_mv_2_submit", "calc_submit_2_reject", "calc_mv_2_approve",
        "calc_submit_2_approve",
    )
}


@query
def data_issues(s):
    return s.shown.select("docid", "planmvdat", "mvdat", "mvseq", "data_issues")


@query
def process_issues(s):
    return s.shown.select("docid", "planmvdat", "mvdat", "mvseq", "process_issues")


@query
def issue_text(s):
    both = s.shown.select("data_issues", "process_issues")
    return both.groupBy("data_issues", "process_issues").agg(F.count(F.lit(1)).alias("n"))


@query
def visit_counters(s):
    status = F.col("planmvstat")
    return s.counted.select(
        "docid", "planspid", "planmvstat",
        report.planned_visit(status).alias("planned_visit"),
        report.performed_visit(status).alias("performed_visit"),
    )


@query
def on_time_flags(s):
    return s.shown.select(
        "docid", "mvdat", "mvseq", "calc_mv_2_submit", "first_submission_on_time",
        "calc_mv_2_approve", "finalization_on_time",
    )


@query
def visit_report(s):
    return report.visit_report(s.stored, AS_OF).select(*REPORT_COLUMNS)


@query
def all_studies(s):
    north, south = (studies.labelled(s.stored, name) for name in ("north", "south"))
    return report.studies_report(studies.all_studies([north, south]), AS_OF)


@query
def plan_links_counted(s):
    links = plans.counted_plan_links(s.plans, s.links)
    return summed(links.select(
        "docid", "planspid", "countryid", "siteid_t", "countryid_t", "sitemonseq_t", COUNT))


@query
def plan_monitors_counted(s):
    return plans.counted_plan_monitors(s.plans, s.links, s.tables.site).drop(STUDY)


@query
def next_approval_date_counted(s):
    return approvals.counted_next_approval_date(s.approvals, AS_OF).drop(STUDY)


@query
def visit_first_submission_counted(s):
    found = visits.with_first_submission(once(s.summarized))
    return found.select(*VISIT, "first_submission_approvalid", "first_submission", COUNT)


@query
def visit_last_submission_counted(s):
    found = visits.with_last_submission(once(s.summarized))
    return found.select(
        *VISIT, "latest_submission_approvalid", "latest_submission", "last_submit_len", COUNT)


@query
def visit_last_rejection_counted(s):
    found = visits.with_last_rejection(once(s.summarized))
    return found.select(
        *VISIT, "latest_rejection_approvalid", "latest_rejection", "last_reject_len", COUNT)


@query
def visit_stage_dates_counted(s):
    return s.staged.drop(STUDY)


@query
def visit_flags_counted(s):
    return s.checked.drop(STUDY)


@query
def plan_left_visit_counted(s):
    return reconcile.counted_left_visit(s.plan_agg, s.checked).drop(STUDY)


@query
def plan_right_visit_counted(s):
    return reconcile.counted_right_visit(s.plan_agg, s.checked).drop(STUDY)


@query
def study_readiness(s):
    columns = warehouse.listing_rows(s.spark, s.path)
    return database.study_readiness(columns.select("table_name").distinct(), columns)


@query
def database_columns(s):
    return plain_names(listed_columns(catalog_listing(s.spark, s.database)))


@query
def database_layouts(s):
    return s.reported.layouts


@query
def database_report(s):
    return s.reported.report


@query
def sql_functions(s):
    register_functions(s.spark)
    return s.spark.sql("""
        SELECT docid, planspid, clean_text(' ' || planspid || '  ' || countryid) AS label,
            weekdays_between(planmvdat, planmvendat) AS weekdays,
            week_start(planmvdat) AS week_start, elapsed_days(planmvdat, planmvendat, 1) AS days,
            visit_length(planmvdat, planmvendat) AS visit_length,
            period_label(planmvdat) AS period,
            CASE WHEN is_weekend(planmvdat) THEN 1 END AS is_weekend
        FROM {plans}""", plans=s.tables.plan)


def entry(spark: SparkSession) -> DataFrame:
    """The visit report over the smallest tables."""
    return queries()["visit_report"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on_tables(build: Callable[[Study], DataFrame]):
        return lambda spark, path: build(Study(spark, path))

    found = {name: on_tables(build) for name, build in QUERIES.items()}
    if registry:
        found |= registry.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = {name: CHECKS[name] for name in QUERIES if name in CHECKS}
    if registry:
        found |= registry.SQL
    return found
