"""Listing of tables and columns the discovery works on.

One command lists all tables of a database that may belong to a study, with where and how each is
stored. Columns are taken from that listing as rows, so no table is asked for one by one.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visittrail.fixed_values import TABLE_HEAD

# A top-level line of the printed schema: indent, name, type.
_FIELD = r"(?m)^ \|-- (.*): \S.* \(nullable = (?:true|false)\)$"


def catalog_listing(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, stored_as, folder, layout, column_names) of the tables named like a study's.

    stored_as is the format, or "view"; folder is NULL where rows are not simply all files of one
    folder (views, partitioned tables). Tables of one layout have the same columns and types. Views
    of the session are listed by the command too and are left out.
    """
    listed = spark.sql(f"SHOW TABLE EXTENDED IN `{database}` LIKE '{TABLE_HEAD}*'")
    text = F.col("information")
    schema = F.substring_index(text, "\nSchema: root\n", -1)
    kind, provider = _entry(text, "Type"), F.lower(_entry(text, "Provider"))
    plain = (kind != "VIEW") & (_entry(text, "Partition Columns") == "")
    return listed.filter(~F.col("isTemporary")).select(
        F.col("tableName").alias("table_name"),
        F.when(kind == "VIEW", "view").otherwise(provider).alias("stored_as"),
        F.when(plain, _entry(text, "Location")).alias("folder"),
        schema.alias("layout"),
        F.regexp_extract_all(schema, F.lit(_FIELD), 1).alias("column_names"),
    )


def listed_tables(listing: DataFrame) -> DataFrame:
    return listing.select("table_name")


def listed_columns(listing: DataFrame) -> DataFrame:
    """(table_name, column_name) of a listing."""
    return listing.select("table_name", F.explode("column_names").alias("column_name"))


def catalog_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the stored tables of a database that may belong to a study."""
    return listed_tables(catalog_listing(spark, database))


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, column_name) of those tables."""
    return listed_columns(catalog_listing(spark, database))


def plain_names(listing: DataFrame) -> DataFrame:
    """Catalog names compared without regard to case or trailing spaces."""
    return listing.select(*(F.lower(F.rtrim(F.col(c))).alias(c) for c in listing.columns))


def _entry(text: Column, name: str) -> Column:
    return F.regexp_extract(text, f"(?m)^{name}: (.*)$", 1)
