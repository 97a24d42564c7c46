"""Every registered query beside its SQL, on the smallest benchmark tables."""

import os

import duckdb
import pytest

import __spark_entry__
from verify import TABLES, compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(__spark_entry__.oracle_sql()))
def test_query(spark, con, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    assert compare(df.columns, df.collect(), con.sql(__spark_entry__.oracle_sql()[name])) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
