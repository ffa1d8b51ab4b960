"""Every registered query against its SQL statement."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
             "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def study(spark):
    return entry.Study(spark, SF)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("nation", "customer", "supplier", "part", "orders", "lineitem"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_a_statement():
    assert set(entry.oracle_sql()) >= set(entry.QUERIES)


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_matches_sql(study, database, name):
    frame = entry.QUERIES[name](study)
    sql = entry.oracle_sql()[name]
    types = {row[0]: row[1] for row in database.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: SQL_TYPES[t] for c, t in frame.dtypes} == types
    columns = sorted(types)
    expected = database.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    assert Counter(map(tuple, frame.select(*columns).collect())) == Counter(expected)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
