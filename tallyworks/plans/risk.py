"""The client risk report: from source tables to dated classes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.dates import month_start, months_before, previous_month_end
from tallyworks.operators import classes, exposure, income, payments
from tallyworks.operators.gate import gate_outcome
from tallyworks.sources.sinks import publish_rows, read_publication, replace_rows
from tallyworks.sources.storage import freeze, frozen_job


@dataclass(frozen=True)
class RiskSources:
    portfolio: DataFrame
    deals: DataFrame
    balances: DataFrame
    cards: DataFrame
    card_daily: DataFrame
    card_usage: DataFrame
    contracts: DataFrame
    first_ledger: DataFrame
    second_ledger: DataFrame
    day_rates: DataFrame
    latest_rates: DataFrame
    salary_wide: DataFrame
    month_cols: Sequence[str]
    premium_card: str
    clients: DataFrame
    schedule: DataFrame
    deal_currency: DataFrame
    vintage: DataFrame


@dataclass(frozen=True)
class RiskReport:
    """The stages of one run; all lazy, each used as often as it is read."""

    sources: RiskSources
    as_of: dt.date

    def exposure(self) -> DataFrame:
        return exposure.exposure_rollup(self.sources.portfolio)

    def credit_portfolio(self, debts: DataFrame) -> DataFrame:
        src = self.sources
        snapshot = exposure.snapshot_as_of(src.balances, "report_date", self.as_of)
        loans = exposure.deal_enrich(debts, src.deals, snapshot)
        cards = exposure.card_enrich(
            exposure.contract_text_match(debts, src.cards),
            exposure.card_snapshot(src.card_daily, src.cards, self.as_of),
        )
        return exposure.portfolio_union(cards, loans)

    def client_debts(self) -> DataFrame:
        # rolled up once: the roll-up feeds the client sums and both kinds of credit
        debts = freeze(self.exposure(), "exposure")
        return exposure.client_exposure(debts, self.credit_portfolio(debts))

    def income(self) -> DataFrame:
        src = self.sources
        hi = previous_month_end(self.as_of)
        lo = months_before(hi, 6)
        first = income.salary_turnover(
            src.first_ledger, src.contracts, src.day_rates, lo, hi, "right"
        )
        second = income.salary_turnover(
            src.second_ledger, src.contracts, src.day_rates, lo, hi, "left"
        )
        wide = income.salary_unpivot_sum(src.salary_wide, src.month_cols, lo)
        return income.avg_income([wide, income.salary_union(second, first)])

    def scheduled(self) -> DataFrame:
        src = self.sources
        due = payments.due_payments(
            src.clients, src.deals, src.schedule, src.deal_currency, self.as_of, numbered=False
        )
        local = payments.fx_latest_convert(due, src.latest_rates, "pay", "currency_id")
        linked = local.join(src.deals.select("deal_no", "deal_id"), "deal_no", "left")
        return payments.deal_payment_max(linked)

    def snapshot_date(self) -> Column:
        """As a value that the plan itself looks up."""
        before = self.sources.balances.where(F.col("report_date") < F.lit(month_start(self.as_of)))
        return before.agg(F.max("report_date")).scalar()

    def payments(self) -> DataFrame:
        src = self.sources
        scheduled = freeze(self.scheduled(), "scheduled")
        estimated = payments.annuity_payment(
            payments.deals_without_schedule(
                src.vintage, src.deals, scheduled, src.balances, self.snapshot_date()
            )
        )
        cards = payments.card_min_payment(src.cards, src.card_usage, src.premium_card)
        return payments.payments_by_client([scheduled, estimated, cards])

    def profile(self) -> DataFrame:
        return classes.client_profile(self.client_debts(), self.income(), self.payments())

    def classes(self) -> DataFrame:
        return classes.risk_class(self.profile())

    def report(self) -> DataFrame:
        return classes.publish_report(self.classes(), self.as_of)


def run_scoring(
    report: RiskReport, checks: DataFrame, report_path: str, export_path: str
) -> str:
    """The whole job: check, publish, replace the export. Returns what was decided.

    ``checks`` comes from the readiness gate. A day's publication is a folder of its own: a job
    that stopped after publishing and is started again puts the same day in place once more.
    """
    outcome = gate_outcome(checks).first()["outcome"]
    if outcome != "run":
        return outcome
    spark = checks.sparkSession
    with frozen_job(spark):
        publish_rows(report.report(), report_path, report.as_of)
        published = read_publication(spark, report_path, report.as_of)
        replace_rows(classes.numbered_publication(published), export_path)
    return outcome
