"""Every registered query against its SQL on DuckDB."""

import re

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as spark_entry
from check_oracles import TABLES, rows_of, types_of

ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, db, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    relation = db.sql(ORACLES[name])
    assert types_of(df) == dict(zip(relation.columns, map(str, relation.dtypes)))
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    assert got == rows_of(relation.columns, relation.fetchall())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[0] == "openalex_id" and df.count() > 0


def test_every_query_has_sql():
    """But for the optional training-data queries that SQL cannot express, which have their own
    tests against brute force."""
    missing = set(spark_entry.queries()) - set(ORACLES)
    assert all(re.match(r"op\d+_|pipeline$", name) for name in missing)
    assert set(ORACLES) <= set(spark_entry.queries())
