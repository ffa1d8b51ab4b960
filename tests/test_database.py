"""From the tables of a database to the report: listing, layouts, many studies, sinks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.small_study import AS_OF, chain, study
from visittrail.plans.database import database_report, study_readiness
from visittrail.plans.report import studies_report
from visittrail.schema import STUDY, TABLE_COLUMNS
from visittrail.sources.catalog import catalog_listing, listed_columns, listed_tables
from visittrail.sources.studies import (
    all_studies,
    read_listed_studies,
    read_study,
    write_layouts,
    write_report,
)

# What each study's tables lack, and what is to be found out about it.
FAMILIES = {
    "repdata_one": ({}, 1, None),
    "repdatanine": ({}, 1, None),
    "repdata_two": ({"plan": {"planmvtyp"}}, 2, None),
    "repdata_three": ({"mv": {"dayid", "mvdate2"}}, 3, None),
    "repdata_four": ({"plan": {"planmvtyp"}, "mv": {"dayid", "mvdate2"}}, 4, None),
    "repdata_none": ({"plan": {"planmvid"}, "mv": {"dayid"}}, 0,
                     "mv has 18 of 19 columns, plan has 9 of 10 columns"),
    "repdata_unlinked": ({"link": set(TABLE_COLUMNS["link"])}, 1, "no link table"),
    "repdata_unnumbered": ({"site": {"sitemonseq"}}, 1, "site has no monitor number"),
    "repdata_part": ({k: set(c) for k, c in TABLE_COLUMNS.items() if k != "plan"}, 0,
                     "mv has 0 of 19 columns, site has 0 of 8 columns, sites has 0 of 2 columns, "
                     "study has 0 of 2 columns, no link table, site has no monitor number"),
}
READY = [p for p, (_, _, reason) in FAMILIES.items() if reason is None]


@pytest.fixture(scope="module")
def database(spark):
    spark.sql("CREATE DATABASE studies")
    for i, (prefix, (missing, _, _)) in enumerate(FAMILIES.items()):
        tables = study(
            spark, prefix, mv=chain((1, "2024-06-01"), (3, f"2024-06-0{i + 2}")),
            plan=[{}, dict(planspid="other", planmvdat="2024-05-30")])
        for kind, columns in TABLE_COLUMNS.items():
            kept = [c for c in columns if c not in missing.get(kind, ())]
            if kept:
                getattr(tables, kind).select(kept).write.saveAsTable(f"studies.{prefix}{kind}")
    spark.range(1).write.saveAsTable("studies.other_plan")
    spark.range(1).createOrReplaceTempView("repdata_sessionplan")
    return "studies"


def rows_of(frame):
    return Counter(map(tuple, frame.collect()))


def normalized_prefix(tables, prefix):
    """Tables read by themselves, under the prefix the discovery has for them."""
    return type(tables)(**{
        kind: table.withColumn(STUDY, F.lit(prefix)) for kind, table in vars(tables).items()})


def test_listing(spark, database):
    listing = catalog_listing(spark, database)
    found = {r["table_name"]: r for r in listing.collect()}
    assert set(found) == {
        f"{prefix}{kind}" for prefix, (missing, _, _) in FAMILIES.items()
        for kind, columns in TABLE_COLUMNS.items() if set(columns) - missing.get(kind, set())}
    assert found["repdata_oneplan"]["column_names"] == TABLE_COLUMNS["plan"]
    assert {r["stored_as"] for r in found.values()} == {"parquet"}
    assert found["repdata_oneplan"]["layout"] == found["repdatanineplan"]["layout"]
    assert found["repdata_oneplan"]["layout"] != found["repdata_twoplan"]["layout"]


def test_odd_tables_are_listed(spark):
    spark.sql("CREATE DATABASE odd")
    spark.sql("CREATE TABLE odd.repdata_aplan (`a: b` INT, s STRUCT<x: INT>, p INT NOT NULL) "
              "USING parquet PARTITIONED BY (p)")
    spark.sql("CREATE VIEW odd.repdata_vplan AS SELECT 1 AS docid, '\n |-- no: int' AS text")
    spark.sql("CREATE TABLE odd.repdata_jplan (docid INT) USING json")
    found = {r["table_name"]: r for r in catalog_listing(spark, "odd").collect()}
    assert {n: (r["stored_as"], r["column_names"], r["folder"] is None) for n, r in found.items()} == {
        "repdata_aplan": ("parquet", ["a: b", "s", "p"], True),
        "repdata_vplan": ("view", ["docid", "text"], True),
        "repdata_jplan": ("json", ["docid"], False),
    }


def test_readiness(spark, database):
    listing = catalog_listing(spark, database)
    found = study_readiness(listed_tables(listing), listed_columns(listing)).collect()
    assert {r["prefix"]: (r["query_number"], r["report_ready"], r["reason"]) for r in found} == {
        prefix: (number, reason is None, reason)
        for prefix, (_, number, reason) in FAMILIES.items()}


def test_report_of_a_database(spark, database):
    found = database_report(spark, database, AS_OF)
    assert found.layouts.count() == len(FAMILIES)
    assert {r[STUDY] for r in found.report.select(STUDY).collect()} == set(READY)
    each = all_studies(
        normalized_prefix(read_study(spark, prefix, database), prefix) for prefix in READY)
    assert rows_of(found.report) == rows_of(studies_report(each, AS_OF))


def test_database_without_ready_studies(spark):
    spark.sql("CREATE DATABASE bare")
    found = database_report(spark, "bare", AS_OF)
    assert found.layouts.collect() == [] and found.report.collect() == []


def test_views_and_other_formats_are_read(spark, database):
    spark.sql("CREATE DATABASE mixed")
    for kind in TABLE_COLUMNS:
        source = spark.table(f"studies.repdata_one{kind}")
        spark.sql(f"CREATE VIEW mixed.repdata_v{kind} AS SELECT * FROM studies.repdata_one{kind}")
        source.write.format("orc").saveAsTable(f"mixed.repdata_o{kind}")
        source.withColumn("part", F.lit(1)).write.partitionBy("part").saveAsTable(
            f"mixed.repdata_p{kind}")
        source.write.saveAsTable(f"mixed.repdata_e{kind}")
        spark.sql(f"CREATE TABLE mixed.repdata_z{kind} LIKE studies.repdata_one{kind}")
    prefixes = [f"repdata_{letter}" for letter in "vopez"]
    found = read_listed_studies(spark, "mixed", catalog_listing(spark, "mixed"), prefixes)
    for kind in ("plan", "mv", "link"):
        expected = rows_of(getattr(read_study(spark, "repdata_one", database), kind).drop(STUDY))
        table = getattr(found, kind)
        for prefix in prefixes[:-1]:
            assert rows_of(table.filter(F.col(STUDY) == prefix).drop(STUDY)) == expected
        assert table.filter(F.col(STUDY) == prefixes[-1]).count() == 0


def test_the_plan_does_not_grow_with_the_studies(spark, database, tmp_path):
    """504 tables: one scan a kind and no more."""
    spark.sql("CREATE DATABASE many")
    folders = {}
    for kind, columns in TABLE_COLUMNS.items():
        folders[kind] = f"{tmp_path}/a+b %1/{kind}"
        spark.table(f"studies.repdata_one{kind}").write.parquet(folders[kind])
        fields = spark.read.parquet(folders[kind]).schema.toDDL()
        for i in range(84):
            spark.sql(f"CREATE TABLE many.repdata_m{i}{kind} ({fields}) USING parquet "
                      f"LOCATION '{folders[kind]}'")
    listing = catalog_listing(spark, "many")
    prefixes = [f"repdata_m{i}" for i in range(84)]
    tables = read_listed_studies(spark, "many", listing, prefixes)
    assert {r[STUDY] for r in tables.plan.select(STUDY).distinct().collect()} == set(prefixes)
    assert tables.plan.count() == 2 * 84
    plan = tables.mv._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan


def test_one_study_is_done_anew(spark, tmp_path):
    path = f"{tmp_path}/report"

    def report(**rows):
        values = [(prefix, i) for prefix, n in rows.items() for i in range(n)]
        return spark.createDataFrame(values, f"{STUDY} string, mvseq int")

    def stored():
        return {r[STUDY]: r["n"] for r in spark.read.parquet(path).groupBy(STUDY).agg(
            F.count("*").alias("n")).collect()}

    write_report(report(one=2, two=3, three=4), path)
    assert stored() == {"one": 2, "two": 3, "three": 4}
    write_report(report(two=1), path)
    assert stored() == {"one": 2, "two": 1, "three": 4}
    write_report(report(), path)
    assert stored() == {"one": 2, "two": 1, "three": 4}
    write_report(report(one=1), path, studies=["one", "three"])
    assert stored() == {"one": 1, "two": 1}


def test_layouts_are_kept_by_prefix(spark, tmp_path):
    path = f"{tmp_path}/layouts"
    fields = "prefix string, query_number int, report_ready boolean, reason string"
    write_layouts(spark.createDataFrame([("a", 1, True, None), ("b", 0, False, "x")], fields), path)
    write_layouts(spark.createDataFrame([("b", 2, True, None)], fields), path)
    assert {r[STUDY]: r["query_number"] for r in spark.read.parquet(path).collect()} == {
        "a": 1, "b": 2}
