"""Every registered query against DuckDB on the same tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from deskwise.registry import QUERIES
from oracle.queries import oracle_sql


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.fixture(scope="module")
def statements():
    return entry.oracle_sql()


def test_every_query_of_the_library_has_a_statement():
    assert oracle_sql().keys() == QUERIES.keys()


def test_statements_are_of_registered_queries(statements):
    assert statements.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches(spark, sf, db, statements, name):
    assert differences(entry.queries()[name](spark, sf), db, statements[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
