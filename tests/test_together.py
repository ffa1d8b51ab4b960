"""Plans and visits are joined where a document and country lie together; files of joins go."""

import pytest

import __spark_entry__ as entry
from tests.small_study import AS_OF, chain, study
from visittrail.operators.reconcile import distinct_plan_visits, plan_visit_rows
from visittrail.plans.report import distinct_visits, plans_with_monitors
from visittrail.sources.studies import SHUFFLE_CLEANUP, stored_study

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("name", "shuffles"), [
    ("durations", 6), ("visit_counters", 6), ("calc_mv_2_submit", 6), ("plan_visit_reconcile", 6),
    ("plan_left_visit", 17), ("plan_left_visit_counted", 17), ("all_studies", 16),
])
def test_visits_are_not_shuffled_again_for_plans(spark, name, shuffles):
    # Large tables are not broadcast.
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = entry.QUERIES[name](entry.Study(spark, SF))
        text = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert "hashpartitioning(plan_slot" not in text and "hashpartitioning(slot" not in text
    assert text.count("Exchange hashpartitioning") <= shuffles


def test_plans_that_become_equal_are_one_row(spark):
    """A lost completed plan is like one recorded as such; plans may differ in their type alone."""
    tables = study(
        spark,
        plan=[dict(planmvdat="2024-01-01", planmvstat=2), dict(planmvdat="2024-01-01", planmvstat=9),
              dict(planmvtyp=1), dict(planmvtyp=2), dict(planmvtyp=None), dict(countryid=None)],
        mv=chain((1, "2024-06-01"))
        + chain((1, "2024-06-01"), mvseq="2", countryid=None)
        + chain((1, "2024-06-01"), mvseq="3", mvdat=None)
        + chain((1, "2024-06-01"), mvseq="4"))
    plans, visits = plans_with_monitors(tables), distinct_visits(tables, AS_OF)
    found = distinct_plan_visits(plans, visits)
    every = plan_visit_rows(plans, visits)
    assert found.columns == every.columns and found.dtypes == every.dtypes
    rows = sorted(map(str, found.collect()))
    assert len(set(rows)) == len(rows)
    assert rows == sorted(map(str, every.distinct().collect()))
    assert sorted(r["planmvtyp"] or 0 for r in found.filter("mvseq = '4'").collect()) == [0, 1, 2, 2]


def test_shuffled_files_of_stored_tables_are_deleted(spark, tmp_path):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {b.name() for b in _listed(manager.getAllBlocks()) if b.isShuffle()}

    # Of frames that tests before left behind, files may go meanwhile, but none is added.
    before = shuffled()
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = stored_study(entry.Study(spark, SF).tables, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert shuffled() <= before
    assert kept.mv.count()
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def _listed(found):
    return [found.apply(i) for i in range(found.size())]
