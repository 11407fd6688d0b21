"""Reading large remote results in parts: the options, and that the parts hold every row once."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyworks.sources import storage


def test_ranges_become_options():
    got = storage.range_options("jdbc:x", "SELECT * FROM t WHERE a > 1", "k", 5, 900, 8)
    assert got == {
        "url": "jdbc:x", "dbtable": "(SELECT * FROM t WHERE a > 1) q", "partitionColumn": "k",
        "lowerBound": "5", "upperBound": "900", "numPartitions": "8",
    }
    days = storage.range_options("jdbc:x", "SELECT 1", "d", dt.date(2001, 1, 1), dt.date(2001, 2, 1), 2)
    assert (days["lowerBound"], days["upperBound"]) == ("2001-01-01", "2001-02-01")


@pytest.mark.parametrize(("low", "high", "parts"), [(2, 1, 3), (1, 2, 0)])
def test_impossible_ranges(low, high, parts):
    with pytest.raises(ValueError, match="no ranges"):
        storage.range_options("jdbc:x", "SELECT 1", "k", low, high, parts)


def test_no_predicates_read_nothing(spark):
    with pytest.raises(ValueError, match="nothing would be read"):
        storage.remote_slices(spark, "jdbc:x", "SELECT 1", [])


@pytest.mark.parametrize("cuts", [[], [3], [9, 3, 3, 20], [-5, 400]])
def test_day_predicates_choose_every_row_once(spark, cuts):
    first = dt.date(2001, 1, 1)
    days = [first + dt.timedelta(days=n) for n in cuts]
    table = spark.range(40).select("id", F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    table = table.unionByName(spark.range(3).select("id", F.lit(None).cast("date").alias("d")))
    predicates = storage.day_predicates("d", days)
    assert len(predicates) == len(set(cuts)) + 1
    found = sum((table.where(p).collect() for p in predicates), [])
    assert sorted(found, key=repr) == sorted(table.collect(), key=repr)
