"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, connection, name):
    problem, n, _ = compare(spark, connection, FOLDER, queries()[name], oracle_sql().get(name))
    assert problem is None and n > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["bin"] for r in rows} == {"minutes", "hours", "days", "weeks", "months"}


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
