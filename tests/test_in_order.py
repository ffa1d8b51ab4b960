"""Rows of a visit or plan are sorted and read through: no group is hashed, stored and merged."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from visittrail import functions as V
from visittrail.operators.approvals import SAME_STEP

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def study(spark):
    return entry.Study(spark, SF)


@pytest.mark.parametrize("name", [
    "visit_summary", "visit_names", "plan_monitors_agg", "visit_counters", "plan_visit_reconcile"])
def test_lists_are_gathered_from_sorted_rows(spark, study, name):
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = entry.QUERIES[name](study)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    # What a group gathers is neither put down in part nor merged.
    assert "ObjectHashAggregate" not in text and "partial_collect" not in text


def test_columns_of_steps_keep_their_order(study):
    chain = study.facts
    assert chain.columns[:6] == [
        "study_prefix", "docid", "sitecounter", "countryid", "visitid", "mvseq"]
    assert chain.columns[6] == next(c for c in SAME_STEP if c not in chain.columns[:6])


@pytest.mark.parametrize(("given", "text"), [
    ([(1, "S", 1), (2, "R", 3)], "S,R,R,R"), ([(2, "A", 2), (1, "S", 1)], "S,A,A"), ([], None),
])
def test_entries_are_repeated_by_their_number(spark, given, text):
    rows = spark.createDataFrame([(given,)], "e array<struct<step int, text string, n bigint>>")
    assert rows.select(V.joined_entries(F.col("e"), ",")).first()[0] == text


@pytest.mark.parametrize("text", ["a\tb", "a\nb\r", " a  b ", "ab", "", None, "\t", "a   b"])
def test_text_is_cleaned_with_and_without_line_ends(spark, text):
    rows = spark.createDataFrame([(text,)], "x string")
    expected = text
    if text is not None:
        expected = "".join(c for c in text if c not in "\t\n\r").replace("  ", " ").strip(" ")
    assert rows.select(V.clean_text(F.col("x"))).first()[0] == expected
