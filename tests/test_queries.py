"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.runner import compare, oracle_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, entry.queries()[name], entry.oracle_sql()[name], FOLDER).startswith("same")


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
