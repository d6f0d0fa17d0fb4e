"""Every query with an SQL counterpart gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry
import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.database(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert compare.difference(df, con.sql(entry.oracle_sql()[name])) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "domain" and df.count() == 20
