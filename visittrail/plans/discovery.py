"""Which studies a catalog holds and which table layout each one has."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visittrail.fixed_values import EXPECTED_COLUMNS, LAYOUTS, TABLE_HEAD
from visittrail.sources.catalog import plain_names

MARKED = {"mv": ["dayid", "mvdate2"], "plan": ["planmvtyp"], "site": [], "sites": [], "study": []}


def study_tables(tables: DataFrame) -> DataFrame:
    """Catalog tables that are named like one of a study, with their prefix and kind."""
    name = F.col("table_name")
    kind = F.coalesce(*(
        F.when(name.like(f"{TABLE_HEAD}%{kind}"), kind) for kind in EXPECTED_COLUMNS
    ))
    return (
        plain_names(tables)
        .withColumn("kind", kind)
        .filter(F.col("kind").isNotNull())
        .withColumn("prefix", F.left(name, F.length(name) - F.length("kind")))
    )


def catalog_prefixes(tables: DataFrame) -> DataFrame:
    return study_tables(tables).select("prefix").distinct()


def layout_counts(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Expected columns present per prefix and kind, from one pass over the listing."""
    known = study_tables(tables).select(
        "prefix", "kind", F.lit(None).alias("column_name"), F.lit(True).alias("is_table")
    )
    listed = study_tables(columns).select(
        "prefix", "kind", "column_name", F.lit(False).alias("is_table")
    )
    kind, column = F.col("kind"), F.col("column_name")
    counts = []
    for name, expected in EXPECTED_COLUMNS.items():
        present = (kind == name) & column.isin(expected)
        counts.append(F.count(F.when(present, 1)).alias(f"{name}_cols"))
        counts += [
            F.count(F.when((kind == name) & (column == marked), 1)).alias(f"{name}_{marked}")
            for marked in MARKED[name]
        ]
    # Columns of a prefix none of whose tables is listed do not make it a study.
    counts.append(F.bool_or("is_table").alias("has_table"))
    counted = known.unionByName(listed).groupBy("prefix").agg(*counts)
    return counted.filter("has_table").drop("has_table")


def layout_classify(counts: DataFrame) -> DataFrame:
    """Number of the report that fits the prefix, 0 when none does."""
    return counts.select("prefix", layout_number().alias("query_number"))


def layout_number() -> Column:
    number = F
    for layout, (sizes, absent) in LAYOUTS.items():
        fits = [F.col(f"{kind}_cols") == size for kind, size in sizes.items()]
        fits += [F.col(column) == 0 for column in absent]
        number = number.when(reduce(and_, fits), layout)
    return number.otherwise(0)


def report_needs(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """(prefix, has_link, has_number): what the report needs but the layout number leaves out.

    That is a link table and the monitor number of a site.
    """
    return with_needs(catalog_prefixes(tables), columns).select(
        "prefix", "has_link", "has_number")


def with_needs(prefixes: DataFrame, columns: DataFrame) -> DataFrame:
    """Rows by prefix with has_link and has_number."""
    name = F.col("table_name")
    listing = plain_names(columns).select(
        F.when(name.like(f"{TABLE_HEAD}%link"), F.left(name, F.length(name) - 4))
        .when(name.like(f"{TABLE_HEAD}%site") & (F.col("column_name") == "sitemonseq"),
              F.left(name, F.length(name) - 4)).alias("prefix"),
        name.like("%link").alias("is_link"),
    ).filter(F.col("prefix").isNotNull()).groupBy("prefix").agg(
        F.bool_or("is_link").alias("has_link"), F.bool_or(~F.col("is_link")).alias("has_number")
    )
    return prefixes.join(listing, "prefix", "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("has_link", "has_number")})


def report_ready(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Whether a prefix also has what the report needs but the layout number leaves out."""
    ready = F.col("has_link") & F.col("has_number")
    return report_needs(tables, columns).select("prefix", ready.alias("report_ready"))
