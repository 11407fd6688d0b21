"""Debt and days past due per deal and per client."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.dates import month_start
from tallyworks.functions.text import pieces

EXPOSURE_KEYS = ("client_id", "tax_id", "deal_id", "source_deal_no", "source_dpd")


def exposure_rollup(
    portfolio: DataFrame, keys: Sequence[str] = EXPOSURE_KEYS, amount: str = "amount"
) -> DataFrame:
    """Loan amount per client, deal and delay."""
    return portfolio.groupBy(*keys).agg(F.sum(amount).cast("decimal(20,2)").alias("debt"))


def snapshot_as_of(df: DataFrame, date_col: str, as_of: dt.date) -> DataFrame:
    """Rows of the newest snapshot taken before the month of ``as_of``."""
    first_day = F.lit(month_start(as_of))
    newest = df.where(F.col(date_col) < first_day).agg(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == newest)


def deal_enrich(exposure: DataFrame, deals: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Add deal attributes, then the snapshot's delay and bucket; source is ``LA``."""
    facts = deals.select(
        "deal_id", F.col("deal_id").alias("linked_deal_id"), "deal_no", "portfolio_type"
    )
    delays = snapshot.select("deal_id", "dpd", "bucket")
    return (
        exposure.join(facts, "deal_id", "left")
        .join(delays, "deal_id", "left")
        .withColumn("credit_source", F.lit("LA"))
    )


def contract_text_match(exposure: DataFrame, contracts: DataFrame, salts: int = 8) -> DataFrame:
    """Deals whose number contains a contract number of the same client.

    A contract number lies inside a deal number exactly when it is one of the deal number's
    substrings, so the containment becomes an equality of client and text, and no task meets more
    pairs than it finds. Substrings are taken in the lengths that the client's contract numbers
    have, of which there are no more than a deal number has characters. A client's deals are
    dealt out to ``salts`` tasks when they meet these lengths.
    """
    usable = contracts.withColumn("_no", F.rtrim("contract_no")).where(F.col("_no") != "")
    # one of 64 bits for each text
    mark = F.expr("shiftleft(1L, CAST(pmod(xxhash64(_no), 64) AS INT))")
    lengths = (
        usable.groupBy("tax_id")
        .agg(F.collect_set(F.length("_no")).alias("_lengths"), F.bit_or(mark).alias("_marks"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = exposure.withColumn("_salt", F.pmod(F.xxhash64("deal_id", "source_deal_no"), F.lit(salts)).cast("int"))
    cut = salted.join(lengths, ["tax_id", "_salt"]).withColumn(
        "_no", F.explode(pieces(F.col("source_deal_no"), F.col("_lengths")))
    )
    # what shares no mark with any of the client's numbers equals none of them and need not be sent to the join
    cut = cut.where(F.col("_marks").bitwiseAND(mark) != 0)
    shown = [*exposure.columns, "contract_no", "contract_id", "credit_limit"]
    return cut.join(usable, ["tax_id", "_no"]).select(*shown)


def card_snapshot(daily: DataFrame, contracts: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest card delays by contract number."""
    return (
        snapshot_as_of(daily, "report_date", as_of)
        .join(contracts.select("contract_id", "contract_no"), "contract_id")
        .select("contract_no", "dpd", "bucket")
    )


def card_enrich(matched: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Add card delays to the matched deals; source is ``CC``.

    Several contracts with an empty number would multiply here, but the text
    match has already dropped them.
    """
    return matched.join(snapshot, "contract_no", "left").withColumn(
        "credit_source", F.lit("CC")
    )


def portfolio_union(cards: DataFrame, loans: DataFrame) -> DataFrame:
    """Both kinds of credit in one shape, duplicates kept."""
    shared = [
        "client_id", "tax_id", "deal_id", "source_deal_no", "source_dpd", "debt", "dpd",
    ]
    card_rows = cards.select(
        *shared,
        F.col("contract_id").alias("linked_id"),
        F.col("contract_no").alias("linked_no"),
        "credit_source",
    )
    loan_rows = loans.select(
        *shared,
        F.col("linked_deal_id").alias("linked_id"),
        F.col("deal_no").alias("linked_no"),
        "credit_source",
    )
    return card_rows.unionByName(loan_rows)


def client_exposure(exposure: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Total debt per client and the worst delay over all the client's deals."""
    debt = exposure.groupBy("client_id", "tax_id").agg(
        F.sum("debt").cast("decimal(20,2)").alias("debt")
    )
    worst = portfolio.groupBy("client_id").agg(F.max("dpd").alias("dpd"))
    return debt.join(worst, "client_id", "left").select("client_id", "tax_id", "debt", "dpd")
