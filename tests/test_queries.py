"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as registered
from compare import differences, sql_connection
from merchant_ledger.plans.oracle import ORACLE
from merchant_ledger.plans.queries import QUERIES

FOLDER = os.environ.get("LEDGER_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return sql_connection(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registered.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    df = registered.queries()[name](spark, FOLDER)
    assert differences(df, connection, registered.oracle_sql()[name]) == []


def test_entry(spark):
    assert registered.entry(spark).count() > 0
