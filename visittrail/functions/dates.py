"""Date columns: weekends, weekday counts, durations and period labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SUNDAY, SATURDAY = 1, 7


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(SUNDAY, SATURDAY)


def week_start(day: Column) -> Column:
    """The Sunday on or before a day."""
    return F.date_add(day, SUNDAY - F.dayofweek(day))


def weekdays_between(one: Column, other: Column) -> Column:
    """Weekdays from one date to the other, both ends counted, in either order."""
    first, last = F.least(one, other), F.greatest(one, other)
    days = F.abs(F.datediff(other, one)) + 1
    weeks = F.abs(F.datediff(week_start(other), week_start(one))) / 7
    return (
        days
        - (weeks * 2).cast("int")
        - (F.dayofweek(first) == SUNDAY).cast("int")
        - (F.dayofweek(last) == SATURDAY).cast("int")
    )


def elapsed_days(start: Column, end: Column, count_start: bool) -> Column:
    """Days from start to end: 1 when not after the start, NULL when either date is missing."""
    days = F.datediff(end, start)
    return F.when(end <= start, 1).when(end > start, days + 1 if count_start else days)


def visit_length(start: Column, end: Column) -> Column:
    """Weekdays of a visit, 1 when it ends on or before its start."""
    return F.when(end <= start, 1).when(end > start, weekdays_between(end, start))


def period_label(day: Column) -> Column:
    """Year and month such as 2020.3, without zero padding."""
    return F.concat(
        F.year(day).cast("string"), F.lit("."), F.month(day).cast("string")
    )
