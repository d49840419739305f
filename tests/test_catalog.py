"""Every registered query against its SQL on the smallest data set."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tools.check_oracles import rows  # noqa: E402
from vetline.catalog.registry import TABLES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return db


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, connection, name):
    df = entry.queries()[name](spark, FOLDER)
    ours = rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert ours
        return
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert ours == rows(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
