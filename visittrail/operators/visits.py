"""Visits: summary of their steps, the dates of key steps, and validation."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visittrail.fixed_values import APPROVE, NOT_PERFORMED, REJECT, STAGE_ISSUES, SUBMIT
from visittrail.functions import (
    clean_text,
    elapsed_days,
    is_bad_stage_order,
    is_weekend,
    joined_entries,
    joined_names,
    latest_stage,
)
from visittrail.operators.approvals import (
    VISIT,
    VISIT_ORDER,
    rejection_days,
    step_block,
    submission_days,
    with_stage_columns,
)
from visittrail.operators.counted import COUNT, counted, expanded, joined, once, summed
from visittrail.operators.plans import in_order
from visittrail.schema import STUDY

SUMMARY_COLUMNS = [
    *VISIT, "mvperf", "mvrepname", "mvdat", "stage", "submitter_name", "stagesubmittorname",
    "rejection_round", "submission_round", "first_submission_approvalid",
    "latest_submission_approvalid", "latest_rejection_approvalid", "approval_date",
    "approvalname", "reviewername", "mvendat", "total_submit_len", "total_cra_time",
    "submission_next", "reject_submit", *STAGE_ISSUES,
]

# How a visit finds a step of another row: everything but the site counter.
STEP_KEY = [STUDY, "docid", "countryid", "visitid"]

# A step's number and stage, by any site counter, in the order rows are sorted by.
NUMBER = ["docid", "countryid", "visitid", "mvseq", STUDY, "approvalid", "approvalstage"]


def visit_summary(steps: DataFrame) -> DataFrame:
    """One row per visit from the rows of approval_steps.

    Steps that differ only in who entered them are counted first. Texts are made from a list of
    distinct steps for each block of numbers, and a visit's from those of its blocks in order, so
    that no list holds all steps of a long visit.

    first, last and reject are the counted (date, days) recorded under the number of the visit's
    first and last submission and last rejection, by any site counter.
    """
    counted = in_order(steps.withColumn("days", _days()), [
        *NUMBER, "approvaldat", "days", "sitecounter", "next_date", "next_stage_reject",
        "approvalname", "mvrepname",
    ]).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.max(c).alias(c) for c in ("mvperf", "mvdat", "mvendat")),
        # The same for all rows of a visit's number.
        F.first("next_approval_id").alias("next_approval_id"),
    )
    n = F.col("n")
    submitted, rejected = F.col("submission_duration"), F.col("rejection_duration")
    resubmitted_at_once = (
        (submitted == 1) & (F.col("next_stage_reject") == 1)
        & (F.col("submission_approvalid") != 1)
    )

    def times(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    # What a step's values make is worked out behind the sort, whose rows are short this way.
    placed = _dated(counted).withColumn("block", step_block())
    staged = with_stage_columns(placed.sortWithinPartitions(*VISIT_ORDER, "block"))
    stage, step, name = F.col("approvalstage"), F.col("approvalid"), F.col("name")
    names = {
        "mvrepname": clean_text(F.col("mvrepname")),
        "submitter_name": F.when(step == 1, name),
        "stagesubmittorname": F.when(stage == SUBMIT, name),
        "approvalname": name,
        "reviewername": F.when(stage.isin(REJECT, APPROVE), name),
    }
    texts = {"stage": ",", "submission_next": ";", "reject_submit": ";"}
    # Before the lists are gathered: there, each would work its values out by itself.
    staged = staged.withColumn("name", clean_text(F.col("approvalname"))).withColumns({
        **names,
        **{c: F.when(F.col(c).isNotNull(), F.struct("approvalid", F.col(c).alias("text"), "n"))
           for c in texts},
    })
    blocks = staged.groupBy(*VISIT_ORDER, "block").agg(
        F.max("mvperf").alias("mvperf"),
        F.max("mvdat").alias("mvdat"),
        times(F.col("rejection_counter").isNotNull()).alias("rejection_round"),
        times(F.col("submission_counter").isNotNull()).alias("submission_round"),
        F.min("submission_approvalid").alias("first_submission_approvalid"),
        F.max("submission_approvalid").alias("latest_submission_approvalid"),
        F.max("rejection_approvalid").alias("latest_rejection_approvalid"),
        F.min_by("dated", "submission_approvalid").alias("first"),
        F.max_by("dated", "submission_approvalid").alias("last"),
        F.max_by("dated", "rejection_approvalid").alias("reject"),
        F.max("approval_date").alias("approval_date"),
        F.max(F.coalesce("mvendat", "mvdat")).alias("mvendat"),
        F.sum(submitted * n).alias("submit_len"), times(rejected == 1).alias("at_once"),
        F.sum(rejected * n).alias("cra_time"), times(resubmitted_at_once).alias("again"),
        *(times(F.col(flag).isNotNull()).alias(flag) for flag in STAGE_ISSUES),
        *(F.collect_list(c).alias(c) for c in texts),
        *(F.collect_set(c).alias(c) for c in names),
    )
    part = F.struct(
        "block", *(joined_entries(F.col(c), sign).alias(c) for c, sign in texts.items()), *names)
    sums = ["rejection_round", "submission_round", *STAGE_ISSUES]
    return (
        in_order(blocks.withColumn("part", part).drop(*texts, *names), VISIT_ORDER).agg(
            *(F.max(c).alias(c) for c in (
                "mvperf", "mvdat", "latest_submission_approvalid", "latest_rejection_approvalid",
                "approval_date", "mvendat")),
            F.min("first_submission_approvalid").alias("first_submission_approvalid"),
            F.min_by("first", "first_submission_approvalid").alias("first"),
            F.max_by("last", "latest_submission_approvalid").alias("last"),
            F.max_by("reject", "latest_rejection_approvalid").alias("reject"),
            *(F.sum(c).alias(c) for c in sums),
            (F.sum("submit_len") - F.sum("at_once")).alias("total_submit_len"),
            (F.sum("cra_time") - F.sum("again")).alias("total_cra_time"),
            F.sort_array(F.collect_list("part")).alias("parts"),
        )
        .withColumns({
            **{c: joined_names(F.flatten(f"parts.{c}")) for c in names},
            **{c: _in_order(c, sign) for c, sign in texts.items()},
        })
        .drop("parts")
    )


def _days() -> Column:
    return F.coalesce(submission_days(), rejection_days())


def _dated(steps: DataFrame) -> DataFrame:
    """With the counted (date, days) recorded under each step's number and stage."""
    same_number, same_days = (Window.partitionBy(*NUMBER, *c) for c in ([], ["approvaldat", "days"]))
    known = F.lit(True)
    for key in STEP_KEY:
        known = known & F.col(key).isNotNull()
    entry = F.struct(F.col("approvaldat").alias("date"), "days", F.col("times").alias(COUNT))
    return (
        steps.withColumn("times", F.sum("n").over(same_days))
        .withColumn("dated", F.when(known, F.collect_set(entry).over(same_number)))
        .drop("days", "times")
    )


def _in_order(column: str, separator: str) -> Column:
    """A visit's text from those of its blocks; NULL when none has any."""
    texts = F.col(f"parts.{column}")
    known = F.array_compact(texts)
    return F.when(F.size("parts") == 1, texts[0]).when(
        F.size(known) > 0, F.array_join(known, separator))


def visit_rows(summary: DataFrame) -> DataFrame:
    """The summary without what dates its key steps."""
    return summary.select(*SUMMARY_COLUMNS)


def submissions(facts: DataFrame) -> DataFrame:
    return _stage_rows(facts, "S", "submission")


def rejections(facts: DataFrame) -> DataFrame:
    return _stage_rows(facts, "R", "rejection")


def _stage_rows(facts: DataFrame, letter: str, word: str) -> DataFrame:
    return facts.filter(F.col("stage") == letter).select(
        *VISIT, "stage", "approvaldat", F.col(f"{word}_approvalid").alias("approvalid"),
        f"{word}_duration",
    )


def visit_first_submission(visits: DataFrame, submitted: DataFrame) -> DataFrame:
    """Visits beside every row of their first submission."""
    return expanded(counted_first_submission(once(visits), submitted))


def visit_last_submission(visits: DataFrame, submitted: DataFrame) -> DataFrame:
    return expanded(counted_last_submission(once(visits), submitted))


def visit_last_rejection(visits: DataFrame, rejected: DataFrame) -> DataFrame:
    return expanded(counted_last_rejection(once(visits), rejected))


def visit_stage_dates(
    visits: DataFrame, submitted: DataFrame, rejected: DataFrame
) -> DataFrame:
    """All three, row by row: repeated step rows repeat the visit."""
    return expanded(counted_stage_dates(once(visits), submitted, rejected))


def counted_first_submission(visits: DataFrame, submitted: DataFrame) -> DataFrame:
    """Counted visits beside each distinct date of their first submission."""
    return _join_rows(visits, submitted, "first_submission_approvalid", {
        "approvaldat": "first_submission",
    })


def counted_last_submission(visits: DataFrame, submitted: DataFrame) -> DataFrame:
    return _join_rows(visits, submitted, "latest_submission_approvalid", {
        "approvaldat": "latest_submission", "submission_duration": "last_submit_len",
    })


def counted_last_rejection(visits: DataFrame, rejected: DataFrame) -> DataFrame:
    return _join_rows(visits, rejected, "latest_rejection_approvalid", {
        "approvaldat": "latest_rejection", "rejection_duration": "last_reject_len",
    })


def counted_stage_dates(
    visits: DataFrame, submitted: DataFrame, rejected: DataFrame
) -> DataFrame:
    """All three: counted visits with the distinct dates of their key steps."""
    first = counted_first_submission(visits, submitted)
    return counted_last_rejection(counted_last_submission(first, submitted), rejected)


def _join_rows(visits: DataFrame, rows: DataFrame, step: str, added: dict) -> DataFrame:
    right = counted(rows.select(
        *(F.col(c).alias(f"r_{c}") for c in [*STEP_KEY, "mvseq", "approvalid"]),
        *(F.col(old).alias(new) for old, new in added.items()),
    ))
    on = F.col("mvseq").eqNullSafe(F.col("r_mvseq")) & (F.col(step) == F.col("r_approvalid"))
    for key in STEP_KEY:
        on = on & (F.col(key) == F.col(f"r_{key}"))
    own = [c for c in visits.columns if c != COUNT]
    return joined(visits, right, on).select(*own, *added.values(), COUNT)


def with_first_submission(summary: DataFrame) -> DataFrame:
    """Counted rows of visit_summary beside each distinct date of their first submission."""
    first = F.col("first")
    several = F.transform(
        F.array_distinct(F.transform(first, lambda e: e["date"])),
        lambda date: F.struct(date.alias("date"), F.aggregate(
            F.filter(first, lambda e: e["date"].eqNullSafe(date)),
            F.lit(0).cast("long"), lambda n, e: n + e[COUNT]).alias(COUNT)))
    one = F.array(F.struct(first[0]["date"].alias("date"), first[0][COUNT].alias(COUNT)))
    dates = F.when(F.size(first) == 1, one).otherwise(several)
    return _beside(summary, "first", dates, {"date": "first_submission"})


def with_last_submission(summary: DataFrame) -> DataFrame:
    added = {"date": "latest_submission", "days": "last_submit_len"}
    return _beside(summary, "last", F.col("last"), added)


def with_last_rejection(summary: DataFrame) -> DataFrame:
    added = {"date": "latest_rejection", "days": "last_reject_len"}
    return _beside(summary, "reject", F.col("reject"), added)


def with_stage_dates(summary: DataFrame) -> DataFrame:
    """All three: the rows of counted_stage_dates, from visit_summary, where its rows lie."""
    dated = with_last_rejection(with_last_submission(with_first_submission(once(summary))))
    added = ["first_submission", "latest_submission", "last_submit_len", "latest_rejection",
             "last_reject_len"]
    return dated.select(*SUMMARY_COLUMNS, *added, COUNT)


def _beside(rows: DataFrame, column: str, entries: Column, added: dict) -> DataFrame:
    """Rows counted with each entry of a list; without any, they keep their own number."""
    entry = F.col(column)
    return rows.withColumn(column, F.explode_outer(entries)).withColumns({
        **{new: entry[old] for old, new in added.items()},
        COUNT: F.col(COUNT) * F.coalesce(entry[COUNT], F.lit(1)),
    }).drop(column)


def visit_days(approvals: DataFrame) -> DataFrame:
    """Each visit's state and start date alone."""
    return approvals.groupBy(*VISIT).agg(
        F.max("mvperf").alias("mvperf"), F.max("mvdat").alias("mvdat"))


def performed_visits(visits: DataFrame) -> DataFrame:
    """Visits known to have taken place: an unknown state counts as not performed."""
    return visits.filter(F.col("mvperf") != NOT_PERFORMED)


def visit_flags(visits: DataFrame) -> DataFrame:
    """Performed visits with their current stage and a 1 in the column of each finding."""
    start, end = F.col("mvdat"), F.col("mvendat")
    first, last = F.col("first_submission"), F.col("latest_submission")
    reject, approve = F.col("latest_rejection"), F.col("approval_date")
    findings = {
        "data_issue_missing_first_submittor_name": F.col("mvrepname").isNull(),
        "data_issue_missing_mv_start_date": start.isNull(),
        "data_issue_missing_mv_end_date": end.isNull(),
        "data_issue_missing_1_submission_stage": F.col("submission_round") == 0,
        "data_issue_missing_latest_submission_date":
            (F.col("submission_round") > 0) & last.isNull(),
        "data_issue_missing_latest_rejection_date":
            (F.col("rejection_round") > 0) & reject.isNull(),
        "data_issue_mv_start_date_after_mv_end_date": start > end,
        "data_issue_mv_end_date_after_approval": end > approve,
        "data_issue_mv_end_date_after_first_submission": end > first,
        "data_issue_last_submission_date_after_next": last > approve,
        "data_issue_last_rejection_date_after_next": reject > approve,
        "data_issue_first_submission_after_latest_rejection": first > reject,
        "data_issue_mv_state_date_is_weekend": is_weekend(start),
        "data_issue_mv_end_date_is_weekend": is_weekend(end),
        "data_issue_wrong_stage_order": is_bad_stage_order(F.col("stage")),
    }
    number = [COUNT] if COUNT in visits.columns else []
    return performed_visits(visits).select(
        *VISIT_COLUMNS[:-1],
        latest_stage(F.col("stage")).alias("current_stage"),
        *STAGE_ISSUES,
        *(F.when(found, 1).alias(flag) for flag, found in findings.items()),
        *number,
    )


def counted_visit_flags(visits: DataFrame) -> DataFrame:
    """The same for counted visits: each distinct validated row once."""
    return summed(visit_flags(visits))


VISIT_COLUMNS = [
    STUDY, "docid", "countryid", "visitid", "mvdat", "mvrepname", "mvseq", "mvendat",
    "submitter_name", "stagesubmittorname", "submission_round", "first_submission",
    "latest_submission", "latest_rejection", "rejection_round", "approval_date",
    "reviewername", "stage", "total_submit_len", "total_cra_time", "submission_next",
    "reject_submit", "last_submit_len", "last_reject_len", "current_stage",
]
