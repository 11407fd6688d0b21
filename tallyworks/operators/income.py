"""Salary inflow and average income per tax id."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.dates import month_end_before
from tallyworks.functions.values import rounded

# fixed values: placeholders that stand for "no tax id"
NO_TAX_ID = ("9999999999", "0000000000", "")


def salary_turnover(
    ledger: DataFrame,
    contracts: DataFrame,
    rates: DataFrame,
    lo: dt.date,
    hi: dt.date,
    closed: str = "right",
    codes: Sequence[int] = (1, 2, 3, 5),
    wanted: str = "A",
    exclude: Sequence[str] = NO_TAX_ID,
    currency: str = "UAH",
) -> DataFrame:
    """Positive salary sums per tax id in local currency.

    ``closed`` says which end of the window belongs to it: ``right`` is (lo, hi],
    ``left`` is [lo, hi). Turnover without a rate for its day is left out.
    """
    day = F.col("real_date")
    if closed == "right":
        in_window = (day > F.lit(lo)) & (day <= F.lit(hi))
    elif closed == "left":
        in_window = (day >= F.lit(lo)) & (day < F.lit(hi))
    else:
        raise ValueError("closed must be 'right' or 'left'")
    local_rates = rates.where(F.col("ccy_to") == currency).select("oper_date", "ccy_from", "rate")
    owners = contracts.where(~F.col("tax_id").isin(*exclude)).select("contract_id", "tax_id")
    return (
        ledger.where(
            in_window & F.col("trans_id").isin(*codes) & (F.col("description") == wanted)
        )
        .join(owners, "contract_id")
        .withColumnRenamed("currency", "ccy_from")
        .join(local_rates, ["oper_date", "ccy_from"], "left")
        .groupBy("tax_id")
        .agg(F.sum(F.col("rate") * F.col("amount")).cast("decimal(24,6)").alias("salary"))
        .where(F.col("salary") > 0)
    )


def salary_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Set union: a client with the same sum in both ledgers counts once."""
    return first.unionByName(second).distinct()


def salary_unpivot_sum(
    wide: DataFrame,
    month_cols: Sequence[str],
    min_date: dt.date,
    exclude: Sequence[str] = NO_TAX_ID[:2],
) -> DataFrame:
    """Sum of the monthly columns per tax id; months ending before ``min_date`` count as zero."""
    kept = {
        name: F.when(
            month_end_before(F.col("report_date"), k) >= F.lit(min_date),
            F.coalesce(F.col(name), F.lit(0)),
        ).otherwise(F.lit(0)).cast("decimal(20,2)")
        for k, name in enumerate(month_cols, start=1)
    }
    windowed = wide.where(~F.col("tax_id").isin(*exclude)).select(
        "tax_id", *[value.alias(name) for name, value in kept.items()]
    )
    any_paid = reduce(lambda a, b: a | b, [F.col(name) != 0 for name in month_cols])
    return (
        windowed.where(any_paid)
        .unpivot("tax_id", list(month_cols), "month", "amount")
        .groupBy("tax_id")
        .agg(F.round(F.sum("amount"), 2).cast("decimal(20,2)").alias("salary"))
    )


def avg_income(parts: Sequence[DataFrame], months: int = 6) -> DataFrame:
    """All salary sums of a tax id divided by a fixed number of months."""
    rows = reduce(
        DataFrame.unionByName,
        [part.select("tax_id", F.col("salary").cast("decimal(24,6)")) for part in parts],
    )
    total = F.sum("salary").cast("double")
    return rows.groupBy("tax_id").agg((total / F.lit(float(months))).alias("avg_salary"))


def salary_unpivot_avg(
    wide: DataFrame,
    month_cols: Sequence[str],
    min_months: int = 3,
    exclude: Sequence[str] = NO_TAX_ID[:2],
) -> DataFrame:
    """Average of the filled months for clients paid recently and often enough."""
    recent = F.coalesce(*[F.col(name) for name in month_cols[:3]], F.lit(0)) > 0
    paid_months: Column = reduce(
        lambda a, b: a + b,
        [F.when(F.coalesce(F.col(c), F.lit(0)) == 0, 0).otherwise(1) for c in month_cols],
    )
    steady = wide.where(
        recent & (paid_months >= min_months) & ~F.col("tax_id").isin(*exclude)
    ).select("tax_id")
    months = wide.select("tax_id", *month_cols).unpivot(
        "tax_id", list(month_cols), "month", "amount"
    )
    # averages need the exact sum and count; the division is done once, in double
    return (
        months.where(F.col("amount").isNotNull())
        .join(steady, "tax_id", "left_semi")
        .groupBy("tax_id")
        .agg(F.sum("amount").cast("double").alias("_sum"), F.count("amount").alias("_n"))
        .select("tax_id", rounded(F.col("_sum") / F.col("_n")).alias("salary"))
    )
