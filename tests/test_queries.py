"""Every driver query against its SQL twin on the smallest tables, and the entry."""

import os

import pytest

import __spark_entry__ as entry
from hubcat.queries import oracle_sql, queries
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    assert compare(spark, tables, QUERIES[name], ORACLE[name], SF) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 200
