"""Every registered query against its SQL on the smallest scale, and the driver contract."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from ledgerlode import catalogue


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    problem, rows = compare.difference(spark, duck, name, SMALL)
    assert problem is None
    assert rows > 0 or name.endswith("quarantine")


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.SQL)
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(catalogue.SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment", "fca_reporting_quarter", "Total Transaction Amount",
                          "Total Transactions", "Average Transaction Value"]
    assert df.count() > 0
