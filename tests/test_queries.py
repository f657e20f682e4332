"""Every registered query that has SQL gives DuckDB's rows on the smallest data set."""

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "tools", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not mounted")


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for table in check.TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    mine = entry.queries()[name](spark, FOLDER)
    theirs = database.sql(entry.oracle_sql()[name]).df()
    assert check.rows(mine.toPandas()) == check.rows(theirs)


def test_entry_has_rows_and_every_query_is_callable(spark):
    assert entry.entry(spark).count() == 70
    assert set(entry.oracle_sql()) <= set(entry.queries())
