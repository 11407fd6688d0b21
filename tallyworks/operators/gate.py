"""Checks that decide whether a scoring run may start."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.dates import month_end, month_start, previous_month_end


def readiness_gate(
    ledger: DataFrame,
    source: DataFrame,
    target: DataFrame,
    published: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """One row per check: (check, expected, actual, passed).

    Every check is a one-row aggregate of its own table. An empty table has no
    date to compare, and its check does not pass.
    """
    last_end = previous_month_end(as_of)
    in_last_month = (F.col("real_date") >= F.lit(month_start(last_end))) & (
        F.col("real_date") < F.lit(month_start(as_of))
    )
    newest = published.agg(F.max("report_date")).scalar()
    last_published = (
        published.where(F.col("report_date") == newest).agg(F.count(F.lit(1))).scalar()
    )

    def row(frame: DataFrame, name: str, expected: Column, actual: Column, passed) -> DataFrame:
        return frame.agg(actual.alias("_a")).select(
            F.lit(name).alias("check"),
            expected.cast("string").alias("expected"),
            F.col("_a").cast("string").alias("actual"),
            F.coalesce(passed(F.col("_a"), expected), F.lit(False)).alias("passed"),
        )

    same = lambda actual, expected: actual == expected
    other = lambda actual, expected: actual != expected
    checks = [
        row(ledger.where(in_last_month), "ledger_complete", F.lit(last_end),
            F.max("real_date").cast("date"), same),
        row(source, "source_fresh", F.lit(last_end), F.max("report_date"), same),
        row(target, "not_loaded_yet", F.lit(month_end(as_of)),
            F.last_day(F.max("input_date")), other),
        row(target, "target_count", last_published, F.count(F.lit(1)), same),
    ]
    return reduce(DataFrame.unionByName, checks)


def gate_outcome(checks: DataFrame) -> DataFrame:
    """One row naming what to do, the first failed check deciding."""

    def failed(name: str) -> Column:
        return F.bool_or((F.col("check") == name) & ~F.col("passed"))

    return checks.agg(
        F.when(failed("ledger_complete"), "incomplete ledger")
        .when(failed("source_fresh"), "missing source")
        .when(failed("not_loaded_yet") | failed("target_count"), "already done")
        .otherwise("run")
        .alias("outcome")
    )


def assert_snapshot_date(df: DataFrame, date_col: str, as_of: dt.date) -> DataFrame:
    """The same rows; reading them fails when one is not dated the last month end."""
    wanted = previous_month_end(as_of)
    checked = F.assert_true(
        F.col(date_col).eqNullSafe(F.lit(wanted)),
        F.concat(F.lit(f"expected {wanted}, found "), F.coalesce(F.col(date_col).cast("string"), F.lit("null"))),
    )
    return df.where(checked.isNull())
