"""From a database to the report: which studies it holds, which can be reported on, and their rows."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visittrail.fixed_values import EXPECTED_COLUMNS
from visittrail.plans.discovery import layout_counts, layout_number, with_needs
from visittrail.plans.report import studies_report
from visittrail.sources.catalog import catalog_listing, listed_columns, listed_tables
from visittrail.sources.studies import StudyTables, read_listed_studies


@dataclass(frozen=True)
class DatabaseReport:
    """The layout of every prefix, and the report on those that are ready."""

    layouts: DataFrame
    report: DataFrame


def study_readiness(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """(prefix, query_number, report_ready, reason): the layout, and what a study lacks if anything.

    A study is ready when its layout is known and it has a link table and its sites a monitor
    number. The reason counts the expected columns of each kind that are there, for kinds that
    lack some, unless the layout is one of those that do without them.
    """
    # Each prefix of a listed table has its counts, so what else it needs is added to these.
    counted = with_needs(layout_counts(tables, columns), columns).withColumn(
        "query_number", layout_number())
    number, parts = F.col("query_number"), []
    for kind, expected in EXPECTED_COLUMNS.items():
        there = F.col(f"{kind}_cols")
        text = F.concat(F.lit(f"{kind} has "), there.cast("string"),
                        F.lit(f" of {len(expected)} columns"))
        parts.append(F.when((number == 0) & (there < len(expected)), text))
    parts.append(F.when(~F.col("has_link"), "no link table"))
    parts.append(F.when(~F.col("has_number"), "site has no monitor number"))
    ready = (number > 0) & F.col("has_link") & F.col("has_number")
    return counted.select(
        "prefix", "query_number", ready.alias("report_ready"),
        F.when(~ready, F.concat_ws(", ", *parts)).alias("reason"))


def database_report(
    spark: SparkSession, database: str, as_of: datetime.date, aliases: DataFrame | None = None
) -> DatabaseReport:
    """The report on every ready study of a database in one job, the study's prefix in front.

    The database is listed once. Which studies are ready is known before the report is planned;
    those that are not are in the layouts, with the reason.
    """
    listing = catalog_listing(spark, database)
    layouts = study_readiness(listed_tables(listing), listed_columns(listing))
    ready = [row["prefix"] for row in layouts.filter("report_ready").select("prefix").collect()]
    tables = read_listed_studies(spark, database, listing, ready)
    return DatabaseReport(layouts, studies_report(tables, as_of, aliases))
