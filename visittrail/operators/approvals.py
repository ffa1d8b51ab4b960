"""Approval rows: the step that follows each one and what every step contributes to its visit."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visittrail.fixed_values import APPROVE, REJECT, STAGE_LETTERS, SUBMIT
from visittrail.functions import clean_text, decode, elapsed_days, joined_names
from visittrail.operators.counted import COUNT, counted, expanded
from visittrail.operators.plans import complete_rows, in_order, together
from visittrail.schema import STUDY, TABLE_COLUMNS

VISIT = [STUDY, "docid", "sitecounter", "countryid", "visitid", "mvseq"]
APPROVAL_COLUMNS = [STUDY, *TABLE_COLUMNS["mv"][:-1]]

# The visit's columns in the order its rows are sorted, grouped and followed by: one sort serves
# what comes after it. The document is in front: it tells most rows apart, the study none or few.
VISIT_ORDER = ["docid", "countryid", "visitid", "mvseq", STUDY, "sitecounter"]

# What makes two approval rows the same step; the rest is reduced to a maximum or a set.
SAME_STEP = [
    STUDY, "docid", "countryid", "visitid", "sitecounter", "mvseq", "approvalid", "dayid",
    "username", "user_full_name", "approvalstage", "approvaldat", "approvalname", "appdurat",
    "mvmultiday",
]

# One outcome of a step: the stage and date recorded under its number.
OUTCOME = [*VISIT, "approvalid", "approvalstage", "approvaldat"]

# The texts of a visit's steps are made in blocks of this many consecutive numbers.
BLOCK = 1024


def complete_approvals(mv: DataFrame) -> DataFrame:
    return complete_rows(mv).select(*APPROVAL_COLUMNS)


def next_approval(approvals: DataFrame) -> DataFrame:
    """Distinct approval rows with the number of the next step of the same visit."""
    return _followed(_together(approvals).distinct()).select(*APPROVAL_COLUMNS, "next_approval_id")


def counted_next_approval_date(approvals: DataFrame, as_of: datetime.date) -> DataFrame:
    """Distinct approval rows with each date of the next step and whether it rejects, counted."""
    alike = Window.partitionBy(*VISIT_ORDER, "back", "result")
    rows = _numbered(counted(_together(approvals).select(*APPROVAL_COLUMNS)))
    dated = rows.withColumn("result", _result()).withColumn(
        "result", F.struct("result.*", F.sum(COUNT).over(alike).alias(COUNT)))
    return (
        _followed(dated, F.col("result"))
        .withColumn("result", F.explode(following_results(as_of, F.lit(1).cast("long").alias(COUNT))))
        .select(*APPROVAL_COLUMNS, "result.next_date", "next_approval_id",
                "result.next_stage_reject", f"result.{COUNT}")
    )


def next_approval_date(approvals: DataFrame, as_of: datetime.date) -> DataFrame:
    """Approval rows beside each row of the next step: its date and whether it rejects."""
    return expanded(counted_next_approval_date(approvals, as_of))


def next_date(has_next: Column, date: Column, as_of: datetime.date) -> Column:
    """Date of the next step; a submission or rejection without one is open until as_of."""
    is_open = F.col("approvalstage").isin(SUBMIT, REJECT)
    return F.when(has_next, date).when(is_open, F.lit(as_of)).alias("next_date")


def step_chain(approvals: DataFrame) -> DataFrame:
    """Distinct steps of every visit, with the number and the distinct results of the next.

    Rows that cannot be matched to another one, for lack of a key, number or site counter, have
    no next step. A visit is followed where its rows lie: it is sorted, and never compared with
    itself, so copies do not multiply.
    """
    # One struct with the number: columns that a table lacks are the same for all rows, see together.
    entered = F.struct(*(c for c in SAME_STEP if c not in VISIT_ORDER)).alias("entered")
    rows = _numbered(_together(approvals)).withColumn("entered", entered)
    steps = in_order(rows, [*VISIT_ORDER, "back", "entered"]).agg(
        F.max("mvperf").alias("mvperf"),
        joined_names(F.collect_set(clean_text(F.col("mvrepname")))).alias("mvrepname"),
        F.max("mvdat").alias("mvdat"),
        F.max("mvdate2").alias("mvendat"),
    )
    return _followed(steps.select("*", "entered.*").drop("entered"), _result()).select(
        *SAME_STEP, "mvperf", "mvrepname", "mvdat", "mvendat", "next_approval_id", "next_results")


def following_results(as_of: datetime.date, *more: Column) -> Column:
    """Distinct (next date, next is a rejection) of a row of the chain, one when unfollowed.

    Whatever else is kept of a result has to be given for the unfollowed one.
    """
    unfollowed = F.struct(
        next_date(F.lit(False), F.lit(None), as_of), F.lit(0).alias("next_stage_reject"), *more
    )
    return F.when(F.col("next_approval_id").isNull(), F.array(unfollowed)).otherwise(
        F.col("next_results")
    )


def approval_steps(approvals: DataFrame, chain: DataFrame, as_of: datetime.date) -> DataFrame:
    """Distinct steps of every visit, once for each distinct result of the step that follows.

    The chain holds the steps of the approvals; these are not read again.
    """
    return (
        chain.withColumn("result", F.explode(following_results(as_of)))
        .drop("next_results")
        .select("*", "result.next_date", "result.next_stage_reject")
        .drop("result")
    )


def submission_days() -> Column:
    return _stage_days(SUBMIT)


def rejection_days() -> Column:
    return _stage_days(REJECT)


def with_stage_columns(steps: DataFrame) -> DataFrame:
    """Columns that sort a step's values by its stage, with its durations and findings."""
    stage, step = F.col("approvalstage"), F.col("approvalid")
    date, name = F.col("approvaldat"), F.col("approvalname")
    submit, reject, approve = stage == SUBMIT, stage == REJECT, stage == APPROVE
    has_next = F.col("next_approval_id").isNotNull()
    pair = F.concat(date.cast("string"), F.lit(","), F.col("next_date").cast("string"))
    without_next_date = has_next & F.col("next_date").isNull()
    next_is_earlier = F.col("next_date") < date

    def finding(condition: Column) -> Column:
        return F.when(condition, 1)

    return steps.withColumns({
        "stage": decode(stage, STAGE_LETTERS),
        "first_submitter_name": F.when(step == 1, name),
        "rejection_counter": F.when(reject, 1),
        "submission_counter": F.when(submit, 1),
        "submission_approvalid": F.when(submit, step),
        "rejection_approvalid": F.when(reject, step),
        "approval_date": F.when(approve, date),
        "approval_approvalid": F.when(approve, step),
        "all_submitter_name": F.when(submit, name),
        "reviewername": F.when(stage.isin(REJECT, APPROVE), name),
        "submission_next": F.when(submit & has_next, pair),
        "reject_submit": F.when(reject & has_next, pair),
        "submission_duration": submission_days(),
        "rejection_duration": rejection_days(),
        "data_issue_missing_stage_submittor_name": finding(submit & name.isNull() & (step != 1)),
        "data_issue_missing_any_submittor_name": finding(submit & name.isNull()),
        "data_issue_missing_stage_reviewer_name": finding(reject & name.isNull()),
        "data_issue_missing_first_submission_date": finding((step == 1) & date.isNull()),
        "data_issue_missing_approval_date": finding(approve & date.isNull()),
        "data_issue_missing_date_in_sub_next_pair": finding(submit & without_next_date),
        "data_issue_missing_date_in_rej_sub_pair": finding(reject & without_next_date),
        "data_issue_wrong_order_of_dates_in_sub_next_pair": finding(submit & next_is_earlier),
        "data_issue_wrong_order_of_dates_in_rej_sub_pair": finding(reject & next_is_earlier),
    })


def approval_facts(approvals: DataFrame, as_of: datetime.date) -> DataFrame:
    """Distinct steps with their next date and stage columns."""
    facts = with_stage_columns(approval_steps(approvals, step_chain(approvals), as_of))
    return facts.select(
        *VISIT, *(c for c in facts.columns if c not in {*VISIT, "approvalstage"}))


def _stage_days(stage: int) -> Column:
    days = elapsed_days(F.col("approvaldat"), F.col("next_date"), count_start=True)
    return F.when(F.col("approvalstage") == stage, days)


def _is_matchable() -> Column:
    known = F.col("docid").isNotNull() & F.col("countryid").isNotNull()
    return known & F.col("visitid").isNotNull() & F.col("approvalid").isNotNull()


def step_block() -> Column:
    """Which block of numbers a step is in; NULL for a step without a number."""
    return F.floor(F.col("approvalid") / BLOCK).cast("int")


def _outcomes(approvals: DataFrame) -> DataFrame:
    return approvals.select(*OUTCOME, step_block().alias("block")).distinct()


def _result() -> Column:
    """What a step means to the one before it."""
    return F.struct(
        F.col("approvaldat").alias("next_date"),
        F.coalesce((F.col("approvalstage") == REJECT).cast("int"), F.lit(0))
        .alias("next_stage_reject"),
    )


def _together(approvals: DataFrame) -> DataFrame:
    return together(approvals)


def _numbered(rows: DataFrame) -> DataFrame:
    """With the step's number counted backwards, which the windows of a visit are sorted by."""
    return rows.withColumn("back", -F.col("approvalid").cast("long"))


def _followed(rows: DataFrame, result: Column | None = None) -> DataFrame:
    """Rows with the number of their visit's next step and the distinct results under it.

    Backwards, the next steps are those already seen: each row is looked at once, however many
    steps a visit has, and the rows of a window may be written to disk.
    """
    seen = Window.partitionBy(*VISIT_ORDER).orderBy("back").rangeBetween(Window.unboundedPreceding, -1)
    followed = _is_matchable() & F.col("sitecounter").isNotNull()
    found = rows if "back" in rows.columns else _numbered(rows)
    added = {"next_approval_id": F.when(followed, F.min("approvalid").over(seen))}
    if result is not None:
        one_number = Window.partitionBy(*VISIT_ORDER, "back")
        found = found.withColumn("results", F.collect_set(result).over(one_number))
        added["next_results"] = F.when(followed, F.min_by("results", "approvalid").over(seen))
    return found.withColumns(added).drop("back", "results", "result")
