"""Every report against its SQL on the generated tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from gearyard.plans.oracle import ORACLE
from gearyard.plans.reports import REPORTS as QUERIES
from tests.compare import DATA, oracle_connection, spark_rows, sql_rows



@pytest.fixture(scope="module")
def con():
    return oracle_connection()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report_equals_sql(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, DATA))
    want_columns, want = sql_rows(con, ORACLE[name])
    assert columns == want_columns
    assert len(rows) == len(want)
    assert rows == want


def test_every_report_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
