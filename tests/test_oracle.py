"""Every named query against its SQL on the smallest tables."""

import pytest
from oracle import compare, duck
from tidemark.registry.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], SQL.get(name)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "rfm_score_string" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())
