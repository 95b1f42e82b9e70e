"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in entry.TEXT_QUERIES])
def test_query(spark, sf_dir, name):
    assert compare(spark, sf_dir, QUERIES[name], SQL.get(name)) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert "p_brand_price_mad" in df.columns
    assert df.count() > 0


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)
