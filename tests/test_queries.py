"""Every registered query against its SQL on DuckDB, and the entry point."""

from __future__ import annotations

import pytest
from comparing import database, difference

import __spark_entry__ as entry
from tallyworks.plans.oracle import ORACLE
from tallyworks.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None


def test_entry_has_rows(spark):
    report = entry.entry(spark)
    assert report.columns == ["report_date", "client_id", "tax_id", "class", "parameters", "score"]
    assert report.count() > 0


def test_every_class_occurs(spark):
    classes = entry.queries()["risk_class"](spark, "/root/testdata/sf0.01")
    assert {row["class"] for row in classes.select("class").distinct().collect()} == {1, 2, 3, 4, 5}
