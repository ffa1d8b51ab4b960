"""Plans and visits put together without a shuffle of all their columns."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.small_study import AS_OF, chain, study
from visittrail.operators.counted import counted, expanded, once
from visittrail.operators.reconcile import (
    counted_right_visit,
    distinct_plan_visits,
    plan_right_visit,
    plan_visit_rows,
)
from visittrail.plans.report import distinct_visits, plans_with_monitors

SF = "/root/testdata/sf0.001"


def rows(frame):
    return sorted(map(str, frame.select(sorted(frame.columns)).collect()))


def tables(spark):
    return study(
        spark,
        plan=[dict(planmvtyp=1), dict(planmvtyp=3), dict(planmvtyp=3), dict(planmvtyp=None),
              dict(planmvdat=None), dict(planmvdat=None), dict(docid=None, planmvstat=2),
              dict(planmvdat="2024-01-01", planmvstat=2), dict(planmvdat="2024-01-01", planmvstat=9)],
        mv=chain((1, "2024-06-01"), (3, "2024-06-03"))
        + chain((1, "2024-06-01"), mvdat=None, mvseq="2")
        + chain((1, "2024-06-02"), docid=None, mvseq="3")
        + chain((1, "2024-06-02"), mvdat="2024-02-02", mvseq="4"))


def test_rows_are_those_of_a_distinct_over_all(spark):
    found = tables(spark)
    plans, visits = plans_with_monitors(found), distinct_visits(found, AS_OF)
    every = plan_visit_rows(plans, visits)
    assert every.count() > every.distinct().count()
    assert rows(distinct_plan_visits(plans, visits)) == rows(every.distinct())


def test_counted_right_rows_are_those_of_the_plain_join(spark):
    found = tables(spark)
    plans, visits = plans_with_monitors(found), distinct_visits(found, AS_OF)
    twice = once(visits).withColumn("n", F.lit(2).cast("long"))
    right = counted_right_visit(plans, twice)
    assert right.count() == right.drop("n").distinct().count()
    assert rows(expanded(right)) == rows(plan_right_visit(plans, visits.unionAll(visits)))
    assert rows(counted(expanded(right))) == rows(right)


@pytest.mark.parametrize(("name", "shuffles"), [
    ("durations", 12), ("plan_visit_reconcile", 12), ("plan_right_visit_counted", 27),
])
def test_reconciled_rows_are_put_together_where_they_lie(spark, name, shuffles):
    # Large tables are not broadcast.
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = entry.QUERIES[name](entry.Study(spark, SF))
        text = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert text.count("Exchange hashpartitioning") <= shuffles
