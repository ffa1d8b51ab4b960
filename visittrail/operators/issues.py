"""Findings as text."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from visittrail.fixed_values import (
    AUTHOR_DAYS,
    AUTHOR_LATE,
    COMPLETED,
    DATA_ISSUES,
    NO_REPORT,
    NO_REPORT_DAYS,
    OVERDUE_PLAN,
    PLANNED,
    PROCESS_LIMITS,
)


def data_issues() -> Column:
    """Texts of all findings whose flag is set and not zero, in rule order."""
    return F.concat_ws(",", *(F.when(F.col(flag) != 0, text) for flag, text in DATA_ISSUES))


def process_issues(as_of: datetime.date) -> Column:
    """Texts of all exceeded limits; expects the plan status as a code and the day counts."""
    today, status = F.lit(as_of), F.col("planmvstat")
    over = [F.when(F.col(days) > limit, text) for days, limit, text in PROCESS_LIMITS]
    took_place = (status == COMPLETED) | status.isNull()
    unreported = F.coalesce("submission_round", F.lit(0)) == 0
    waiting = F.datediff(today, F.col("mvendat")) > NO_REPORT_DAYS
    return F.trim(F.concat_ws(
        ",",
        *over,
        F.when(took_place & unreported & waiting, NO_REPORT),
        F.when(F.col("total_cra_time") > AUTHOR_DAYS, AUTHOR_LATE),
        F.when((status == PLANNED) & (today > F.col("planmvendat")), OVERDUE_PLAN),
    ))
