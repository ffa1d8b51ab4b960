"""A study family and a catalog listing derived from order, customer and part tables.

Every row of the source tables is used. Missing values, late dates and repeated keys are
spread over the rows by key arithmetic so that each rule of the report has something to find.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visittrail.fixed_values import EXPECTED_COLUMNS, TABLE_HEAD
from visittrail.schema import TABLE_COLUMNS
from visittrail.sources.studies import StudyTables, normalized

AS_OF = datetime.date(1999, 6, 30)
PREFIX = "warehouse"


def warehouse_study(spark: SparkSession, path: str, prefix: str | Column = PREFIX) -> StudyTables:
    tables = {
        "plan": plan_rows(spark, path),
        "mv": approval_rows(spark, path),
        "site": site_rows(spark, path),
        "sites": site_label_rows(spark, path),
        "study": study_rows(spark, path),
        "link": link_rows(spark, path),
    }
    return StudyTables(**{k: normalized(k, rows, prefix) for k, rows in tables.items()})


def plan_rows(spark: SparkSession, path: str) -> DataFrame:
    key = F.col("o_orderkey")
    start = F.when(key % 5 == 0, F.date_add(_order_day(), 1)).otherwise(_order_day())
    span = (key % 4).cast("int")
    early = F.when(key % 23 == 0, 5).otherwise(0)
    odd = F.when(key % 9 == 0, 3).otherwise(0)
    return _orders_of_customers(spark, path).select(
        F.col("o_custkey").alias("docid"),
        _country("c_nationkey").alias("countryid"),
        key.alias("planspid"),
        F.when(key % 17 == 0, None).when(key % 13 == 0, 1).otherwise(span + 1).alias("planmvtyp"),
        key.alias("planmvid"),
        F.when(key % 19 != 0, start).alias("planmvdat"),
        F.when(key % 21 != 0, F.date_add(_order_day(), span - early)).alias("planmvendat"),
        F.when(key % 27 != 0, span + 1 + odd).alias("planmvdurat"),
        _coded("o_orderstatus", {"O": 1, "F": 2, "P": 3}).alias("planmvstat"),
        _status(key).alias("record_status"),
    )


def approval_rows(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.parquet(f"{path}/lineitem.parquet")
    visits = _orders_of_customers(spark, path)
    key, line, person = F.col("o_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")
    waited = (line * 4 + person % 5 - 6).cast("int")
    spent = (key % 4).cast("int") - F.when(key % 43 == 0, 5).otherwise(0)
    return lines.join(visits, lines["l_orderkey"] == visits["o_orderkey"]).select(
        F.col("o_custkey").alias("docid"),
        (key % 3).alias("sitecounter"),
        _country("c_nationkey").alias("countryid"),
        (key % 4 + 1).cast("int").alias("visitid"),
        line.alias("approvalid"),
        F.when(key % 3 != 0, key % 5).alias("mvseq"),
        F.when(key % 11 == 0, 2).when(key % 47 != 0, 1).alias("mvperf"),
        F.when(key % 31 != 0, F.concat(F.lit("rep"), (F.col("o_custkey") % 50).cast("string")))
        .alias("mvrepname"),
        F.when(key % 37 != 0, _order_day()).alias("mvdat"),
        _coded("l_returnflag", {"N": 1, "R": 2, "A": 3}).alias("approvalstage"),
        F.when(F.col("l_partkey") % 41 != 0, F.date_add(_order_day(), waited))
        .alias("approvaldat"),
        F.when(person % 10 != 0, F.concat(F.lit(" rev  "), person.cast("string")))
        .alias("approvalname"),
        *(F.lit(None).cast("string").alias(name)
          for name in ("dayid", "username", "user_full_name", "appdurat", "mvmultiday")),
        F.when(key % 7 != 0, F.date_add(_order_day(), spent)).alias("mvdate2"),
        _status(key).alias("record_status"),
    )


def site_rows(spark: SparkSession, path: str) -> DataFrame:
    """Each customer runs a site; suppliers run a second one under the same document number."""
    def rows(table: str, key: str, name: str, nation: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{table}.parquet").select(
            F.col(key).alias("docid"),
            _site(F.col(key)).alias("siteid"),
            F.when(F.col(key) % 9 != 0, F.concat(F.lit("Mon\t"), F.col(nation).cast("string")))
            .alias("sitemonfirst"),
            F.col(name).alias("sitemonlast"),
            _country(nation).alias("countryid"),
            (F.col(key) % 2).alias("sitemonseq"),
            F.lit("Complete ").alias("record_status"),
        )

    return rows("customer", "c_custkey", "c_name", "c_nationkey").unionByName(
        rows("supplier", "s_suppkey", "s_name", "s_nationkey")
    )


def site_label_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/nation.parquet").select(
        F.col("n_name").alias("label"), _code("n_nationkey").alias("sitecode")
    )


def study_rows(spark: SparkSession, path: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return spark.read.parquet(f"{path}/customer.parquet").select(
        F.when(segment == "AUTOMOBILE", "ALTTO").when(segment == "BUILDING", "CD2")
        .otherwise(segment).alias("studyid"),
        F.col("c_custkey").alias("docid"),
    )


def link_rows(spark: SparkSession, path: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return _orders_of_customers(spark, path).select(
        customer.alias("docid"),
        _country("c_nationkey").alias("countryid"),
        key.alias("planspid"),
        F.lit("PLAN").alias("tblname"),
        F.when(key % 8 == 0, "link_other").otherwise("link_mvplanning").alias("fldname"),
        (key % 3).alias("sitecounter_t"),
        _country("c_nationkey").alias("countryid_t"),
        _site(customer).alias("siteid_t"),
        (customer % 2).alias("sitemonseq_t"),
        F.lit("SITE").alias("tblname_t"),
    )


def alias_rows(spark: SparkSession, path: str) -> DataFrame:
    """(protocol, alias) of the customers' market segments, one of them under another code."""
    segment = F.col("c_mktsegment")
    listed = F.when(segment == "MACHINERY", "MACHINES").otherwise(segment)
    return (
        spark.read.parquet(f"{path}/customer.parquet")
        .select(listed.alias("protocol"), F.concat(segment, F.lit(" project")).alias("alias"))
        .distinct()
    )


def column_rows(spark: SparkSession, path: str) -> DataFrame:
    """(table_name, column_name): a table family for each part, some with columns left out."""
    expected = F.array(*(
        F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("column_name"))
        for kind, names in EXPECTED_COLUMNS.items() for name in names
    ))
    key = F.col("p_partkey")
    left_out = (
        ((key % 2 == 0) & (F.col("c.column_name") == "planmvtyp"))
        | ((key % 3 == 0) & F.col("c.column_name").isin("dayid", "mvdate2"))
        | ((key % 11 == 0) & (F.col("c.kind") == "study"))
        | ((key % 13 == 0) & (F.col("c.column_name") == "planmvid"))
    )
    return (
        _parts(spark, path)
        .select("p_partkey", F.explode(expected).alias("c"))
        .filter(~left_out)
        .select(
            F.concat(F.lit("repdata_p"), key.cast("string"), F.lit("_"), F.col("c.kind"))
            .alias("table_name"),
            F.col("c.column_name"),
        )
    )


def table_rows(spark: SparkSession, path: str) -> DataFrame:
    return column_rows(spark, path).select("table_name").distinct()


def listing_rows(spark: SparkSession, path: str) -> DataFrame:
    """column_rows and what the report needs besides: link tables and monitor numbers, most of them."""
    key = F.col("p_partkey")
    prefix = F.concat(F.lit("repdata_p"), key.cast("string"), F.lit("_"))
    parts = _parts(spark, path)
    links = parts.filter(key % 5 != 0).select(
        F.concat(prefix, F.lit("link")).alias("table_name"),
        F.explode(F.array(*map(F.lit, TABLE_COLUMNS["link"]))).alias("column_name"))
    numbers = parts.filter(key % 7 != 0).select(
        F.concat(prefix, F.lit("site")).alias("table_name"), F.lit("sitemonseq").alias("column_name"))
    return column_rows(spark, path).unionByName(links).unionByName(numbers)


#: The studies of the stored database: documents are dealt to them by site, so that no row of one
#: study meets another's. Each has its prefix and what its tables lack.
STORED_STUDIES = [
    ("repdata_s0", {}),
    ("repdatas1", {"plan": ["planmvtyp"]}),
    ("repdata_s2", {"mv": ["dayid", "mvdate2"]}),
    ("repdatas3", {"plan": ["planmvtyp"], "mv": ["dayid", "mvdate2"]}),
    ("repdata_s4", {"plan": ["planmvid"]}),
    ("repdata_s5", {"link": TABLE_COLUMNS["link"]}),
    ("repdata_s6", {}),
]


def study_of(document: str) -> Column:
    """Which of the stored studies a document belongs to, by number."""
    return (F.floor(F.col(document) / 4) % len(STORED_STUDIES)).cast("int")


def stored_database(spark: SparkSession, path: str, folder: str, database: str) -> str:
    """Writes the stored studies under a folder and puts their tables in a new database.

    Each kind is written once, in a folder per study; a table is one such folder.
    """
    rows = {
        "plan": plan_rows, "mv": approval_rows, "site": site_rows, "sites": site_label_rows,
        "study": study_rows, "link": link_rows,
    }
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{folder}/database'")
    for kind, build in rows.items():
        made = normalized(kind, build(spark, path), PREFIX).select(*TABLE_COLUMNS[kind])
        every = F.explode(F.array(*map(F.lit, range(len(STORED_STUDIES)))))
        made.withColumn("of", study_of("docid") if "docid" in made.columns else every).write.parquet(
            f"{folder}/{kind}", partitionBy="of")
        for number, (prefix, missing) in enumerate(STORED_STUDIES):
            fields = ", ".join(
                f"`{name}` {dtype}" for name, dtype in made.dtypes
                if name not in missing.get(kind, ()))
            if fields:
                spark.sql(f"CREATE TABLE `{database}`.`{prefix}{kind}` ({fields}) USING parquet "
                          f"LOCATION '{folder}/{kind}/of={number}'")
    return database


def _orders_of_customers(spark: SparkSession, path: str) -> DataFrame:
    orders = spark.read.parquet(f"{path}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    customers = spark.read.parquet(f"{path}/customer.parquet").select("c_custkey", "c_nationkey")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"])


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Keys of the parts, dealt out: few bytes become dozens of rows each, on every core."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.read.parquet(f"{path}/part.parquet").select("p_partkey").repartition(
        tasks, "p_partkey")


def _order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def _code(nation: str) -> Column:
    return F.lpad(F.col(nation).cast("string"), 3, "0")


def _country(nation: str) -> Column:
    return F.concat(_code(nation), F.lit("-S"))


def _site(customer: Column) -> Column:
    return F.concat(F.lit(" Site  "), F.floor(customer / 4).cast("string"))


def _status(key: Column) -> Column:
    return F.when(key % 29 == 0, "incomplete").otherwise("Complete")


def _coded(letter: str, codes: dict[str, int]) -> Column:
    return F.coalesce(*(F.when(F.col(letter) == k, v) for k, v in codes.items()))
