"""Expected monthly payments per deal and per client."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.dates import month_boundaries
from tallyworks.functions.values import rounded
from tallyworks.operators.numbering import number_rows

PAYMENT = "decimal(19,4)"
PAYMENT_COLUMNS = ("tax_id", "deal_no", "deal_id", "payment")


def due_payments(
    clients: DataFrame,
    deals: DataFrame,
    schedule: DataFrame,
    currency: DataFrame,
    as_of: dt.date,
    days: int = 31,
    numbered: bool = True,
) -> DataFrame:
    """Unpaid instalments due less than ``days`` before or after ``as_of``.

    Amounts are in minor units. ``rn`` numbers a deal's instalments by date; it
    costs a stored sort, so jobs that do not show it switch it off.
    """
    near = schedule.where(
        (F.col("status") == 0)
        & (F.col("arc_date") > F.lit(as_of - dt.timedelta(days=days)))
        & (F.col("arc_date") < F.lit(as_of + dt.timedelta(days=days)))
    ).select(
        "deal_id",
        "arc_date",
        "status",
        *[
            (F.col(name) / 100).cast(PAYMENT).alias(name)
            for name in ("principal", "interest", "fee", "rest")
        ],
    )
    known = currency.where(F.col("currency_id").isNotNull()).select("deal_no", "currency_id")
    rows = (
        near.join(deals.select("deal_id", "deal_no", "client_id"), "deal_id")
        .join(clients.select("client_id", "tax_id"), "client_id")
        .join(known, "deal_no", "left")
        .select(
            "tax_id", "deal_no", "currency_id", "arc_date", "status",
            "principal", "interest", "fee", "rest",
            (F.col("principal") + F.col("interest") + F.col("fee")).cast(PAYMENT).alias("pay"),
        )
    )
    if not numbered:
        return rows
    ties = ["principal", "interest", "fee", "rest"]
    return number_rows(rows, ["arc_date", *ties], "rn", within=["deal_no"])


def fx_latest_convert(
    df: DataFrame, rates: DataFrame, amount: str, ccy: str, name: str = "payment"
) -> DataFrame:
    """Amount at the newest rates; no currency leaves it as it is, no rate gives null."""
    newest = rates.agg(F.max("rate_date")).scalar()
    current = rates.where(F.col("rate_date") == newest).select(
        F.col("currency_code").alias(ccy), F.col("rate").alias("_rate")
    )
    value = F.col(amount).cast(PAYMENT)
    converted = F.when(F.col(ccy).isNull(), value).otherwise(
        F.round(value * F.col("_rate"), 2).cast(PAYMENT)
    )
    return df.join(current, ccy, "left").withColumn(name, converted).drop("_rate")


def deal_payment_max(df: DataFrame) -> DataFrame:
    """Largest positive payment of each deal."""
    return (
        df.groupBy("tax_id", "deal_no", "deal_id")
        .agg(F.max("payment").alias("payment"))
        .where(F.col("payment") > 0)
    )


def deals_without_schedule(
    vintage: DataFrame,
    deals: DataFrame,
    paid: DataFrame,
    balances: DataFrame,
    snapshot_date: dt.date | Column,
) -> DataFrame:
    """Open deals with a balance and no scheduled payment, with rate and remaining months."""
    owed = F.col("principal") + F.col("past_principal") + F.col("interest") + F.col("past_interest")
    balance = balances.where(
        (F.col("report_date") == F.lit(snapshot_date)) & (F.col("outstanding") > 0) & (owed > 0)
    ).select("deal_id", "report_date", "principal")
    months = month_boundaries(F.col("report_date"), F.col("expected_close"))
    return (
        vintage.where(F.col("close_date").isNull())
        .join(paid.select("deal_no"), "deal_no", "left_anti")
        .join(balance, "deal_id")
        .join(deals.select("deal_id", "interest_rate"), "deal_id", "left")
        .select(
            "tax_id",
            "deal_no",
            "deal_id",
            "principal",
            F.coalesce("interest_rate", F.lit(0)).alias("interest_rate"),
            F.when(months <= 0, 1).otherwise(months).alias("term"),
        )
    )


def annuity_payment(
    df: DataFrame,
    principal: str = "principal",
    rate: str = "interest_rate",
    term: str = "term",
) -> DataFrame:
    """Equal monthly payment for a yearly percentage rate."""
    amount = F.col(principal).cast("double")
    step = F.col(rate).cast("double") / 1200
    growth = F.pow(1 + step, F.col(term).cast("double"))
    payment = F.when(F.col(rate) == 0, amount / F.col(term)).otherwise(
        amount * step * growth / (growth - 1)
    )
    return df.select(
        "tax_id", "deal_no", "deal_id", rounded(payment).cast(PAYMENT).alias("payment")
    )


def card_min_payment(
    contracts: DataFrame, usage: DataFrame, premium: str
) -> DataFrame:
    """A tenth (premium cards) or a twentieth of the limit, or of the debt without a limit."""
    limit = F.coalesce("credit_limit", F.lit(0))
    used = F.coalesce("outstanding", F.lit(0))
    base = F.when(limit == 0, used).otherwise(F.col("credit_limit"))
    share = F.when(F.col("subgroup") == premium, F.lit("0.10")).otherwise(F.lit("0.05"))
    return (
        contracts.where(F.col("tax_id").isNotNull())
        .join(usage.select("contract_id", "outstanding"), "contract_id", "left")
        .where(limit + used > 0)
        .select(
            "tax_id",
            F.col("contract_no").alias("deal_no"),
            F.col("contract_id").alias("deal_id"),
            (base * share.cast("decimal(3,2)")).cast(PAYMENT).alias("payment"),
        )
    )


def payments_by_client(parts: Sequence[DataFrame]) -> DataFrame:
    """All payments of a client added up, duplicates kept."""
    rows = reduce(DataFrame.unionByName, [part.select(*PAYMENT_COLUMNS) for part in parts])
    return rows.groupBy("tax_id").agg(F.sum("payment").cast("decimal(25,4)").alias("payment"))
