"""Every named query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from millrace import plans
from tests.compare import spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.SQL)
    assert set(plans.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_same_rows_as_sql(spark, name):
    got = spark_rows(plans.QUERIES[name](spark, SF_DIR))
    want = sql_rows(SF_DIR, plans.SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    assert entry.entry(spark).columns == ["k", "v", "s"]
