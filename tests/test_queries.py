"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert differences(df, connection, entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
