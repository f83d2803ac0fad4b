"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    problem, _, _ = compare(spark, con, name, QUERIES[name], ORACLE.get(name), sf_dir)
    assert problem is None, problem


def test_entry_has_a_stable_schema(spark):
    assert entry.entry(spark).schema == entry.entry(spark).schema
