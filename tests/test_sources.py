"""Study tables and the catalog as a database holds them."""

import pytest
from pyspark.sql import functions as F

from tests.small_study import AS_OF, USUAL, chain, study
from visittrail.plans.discovery import catalog_prefixes, layout_classify, layout_counts, report_ready
from visittrail.plans.report import studies_report, visit_report
from visittrail.schema import TABLE_COLUMNS
from visittrail.sources.catalog import catalog_columns, catalog_tables
from visittrail.sources.studies import read_study, read_study_files, write_report

LEFT_OUT = {
    "one": {}, "two": {"plan": {"planmvtyp"}}, "three": {"mv": {"dayid", "mvdate2"}},
    "four": {"plan": {"planmvtyp"}, "mv": {"dayid", "mvdate2"}},
    "none": {"plan": {"planmvid"}}, "nil": {"mv": {"dayid"}},
}


@pytest.fixture(scope="module")
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS clinic")
    for prefix, missing in LEFT_OUT.items():
        tables = study(spark, prefix, mv=chain((1, "2024-06-01"), (3, "2024-06-02")))
        for kind, columns in TABLE_COLUMNS.items():
            kept = [c for c in columns if c not in missing.get(kind, ())]
            getattr(tables, kind).select(*kept).write.mode("overwrite").saveAsTable(
                f"clinic.repdata_{prefix}{kind}"
            )
    spark.range(1).write.mode("overwrite").saveAsTable("clinic.other_plan")
    spark.range(1).createOrReplaceTempView("repdata_sessionplan")
    return "clinic"


def test_layouts(spark, database):
    tables, columns = catalog_tables(spark, database), catalog_columns(spark, database)
    names = {r["table_name"] for r in tables.collect()}
    assert "repdata_sessionplan" not in names and "other_plan" not in names
    assert {r["prefix"] for r in catalog_prefixes(tables).collect()} == {
        f"repdata_{p}" for p in LEFT_OUT
    }
    classes = layout_classify(layout_counts(tables, columns)).collect()
    assert {r["prefix"]: r["query_number"] for r in classes} == {
        "repdata_one": 1, "repdata_two": 2, "repdata_three": 3, "repdata_four": 4,
        "repdata_none": 0, "repdata_nil": 0,
    }
    ready = report_ready(tables, columns).collect()
    assert all(r["report_ready"] for r in ready) and len(ready) == len(LEFT_OUT)


def test_missing_study_table_is_layout_0(spark, database):
    tables, columns = catalog_tables(spark, database), catalog_columns(spark, database)
    without = F.col("table_name") != "repdata_onestudy"
    classes = layout_classify(layout_counts(tables.filter(without), columns.filter(without)))
    assert classes.filter("prefix = 'repdata_one'").first()["query_number"] == 0


def test_report_of_stored_tables(spark, database):
    row = visit_report(read_study(spark, "repdata_one", database), AS_OF).first()
    assert row["stage"] == "S,A" and row["data_issues"] == ""


def test_layout_without_visit_type_has_no_type_finding(spark, database):
    row = visit_report(read_study(spark, "two", database), AS_OF).first()
    assert "Missing type of a visit" not in row["data_issues"]


def test_layout_without_end_date_ends_on_the_start(spark, database):
    row = visit_report(read_study(spark, "three", database), AS_OF).first()
    assert row["mvendat"] == row["mvdat"]


def test_unusable_dates_become_null(spark):
    bad = study(spark, plan=[dict(planmvdat="0000-00-00")])
    assert bad.plan.first()["planmvdat"] is None


def test_studies_in_files(spark, tmp_path):
    for prefix in ("a", "b"):
        tables = study(spark, prefix, mv=chain((1, "2024-06-01"), (3, "2024-06-02")))
        for kind in USUAL:
            getattr(tables, kind).write.mode("append").partitionBy("study_prefix").parquet(
                f"{tmp_path}/in/{kind}"
            )
    stored = read_study_files(spark, f"{tmp_path}/in")
    assert {r["study_prefix"] for r in stored.plan.collect()} == {"a", "b"}
    write_report(studies_report(stored, AS_OF), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
