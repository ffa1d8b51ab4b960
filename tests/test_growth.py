"""How often rows are shuffled and listings worked out: what grows with the tables."""

import pytest

import __spark_entry__ as entry
from visittrail.sources.warehouse import column_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def study(spark):
    return entry.Study(spark, SF)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "visit_flags", "visit_flags_counted", "visit_stage_dates", "visit_stage_dates_counted",
    "visit_last_submission", "visit_last_rejection", "visit_summary", "visit_names",
    "stage_sequence", "stage_date_pairs", "stage_order_check", "current_stage",
    "visit_issue_counts", "performed_visits", "next_approval_date", "next_approval_date_counted",
])
def test_steps_are_shuffled_once_and_never_joined_with_themselves(study, name):
    text = plan(entry.QUERIES[name](study))
    # One shuffle by visit; the joins that derive the steps from the tables may have two each.
    assert text.count("hashpartitioning(docid") == 1
    assert text.count("Exchange hashpartitioning") <= 5
    assert text.count("lineitem.parquet") == 1


def test_readiness_works_the_listing_out_three_times(study):
    assert plan(entry.QUERIES["study_readiness"](study)).count("part.parquet") <= 9


def test_parts_are_dealt_out_before_they_multiply(spark, study):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert column_rows(spark, SF).rdd.getNumPartitions() == tasks


def test_step_shuffles_start_with_many_parts(spark, study):
    text = plan(entry.QUERIES["next_approval_date"](study))
    assert "hashpartitioning(docid" in text and ", 1000), REPARTITION_BY_COL" in text
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
