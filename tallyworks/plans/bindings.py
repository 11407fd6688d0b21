"""Roles the operators read, derived from the test tables.

Every role covers its whole table; the oracle SQL uses the same formulas.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.dates import months_before, previous_month_end
from tallyworks.sources.storage import load

# fixed values: the day the test data is looked at, and dates around it
AS_OF = dt.date(2001, 8, 15)
MAX_DATE = previous_month_end(AS_OF)
MIN_DATE = months_before(MAX_DATE, 6)
SNAPSHOT_DATES = (dt.date(2001, 6, 30), dt.date(2001, 7, 31), dt.date(2001, 8, 10))
RATE_DAYS = (dt.date(2001, 1, 1), dt.date(2001, 8, 31))
RATE_DATES = (dt.date(2001, 7, 30), dt.date(2001, 7, 31))
EARLY_REPORT = dt.date(2001, 6, 15)
MONTH_COLS = tuple(f"paid_{k}m" for k in range(1, 7))
WIDE_MONTHS = tuple(range(2, 37))
PREMIUM_CARD = "GOLD"

ORDER_TAX_ID = "lpad(CAST(o_custkey AS STRING), 10, '0')"
DEAL_NO = "concat('D', o_orderkey, '-', o_orderstatus)"
BASE_DELAY = "(o_custkey * 7) % 100 + o_orderkey % 5"
RATE = "CAST(1 + n_nationkey * 0.1BD AS DECIMAL(10,4))"


def _money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(14,2))"


def _share(column: str, part: str) -> str:
    """Exact fraction of an amount."""
    return f"CAST({_money(column)} * {part}BD AS DECIMAL(18,4))"


def _day(column: str) -> str:
    return f"CAST({column} AS DATE)"


def _dates(days) -> str:
    return "array(" + ", ".join(f"DATE '{day}'" for day in days) + ")"


@dataclass(frozen=True)
class Roles:
    """Role tables of one data folder."""

    spark: SparkSession
    folder: str
    _tables: dict[str, DataFrame] = field(default_factory=dict, compare=False, repr=False)

    def table(self, name: str) -> DataFrame:
        """One stored table; its footer is read once however often it is used."""
        if name not in self._tables:
            self._tables[name] = load(self.spark, self.folder, name)
        return self._tables[name]

    @property
    def portfolio(self) -> DataFrame:
        orders = self.table("orders").selectExpr(
            "o_orderkey AS deal_id",
            "o_custkey AS client_id",
            f"{ORDER_TAX_ID} AS tax_id",
            f"{DEAL_NO} AS source_deal_no",
            f"{BASE_DELAY} AS source_dpd",
            f"DATE '{MAX_DATE}' AS report_date",
        )
        lines = self.table("lineitem").selectExpr(
            "l_orderkey AS deal_id", f"{_money('l_extendedprice')} AS amount"
        )
        return orders.join(lines, "deal_id")

    @property
    def deals(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS deal_id",
            f"{DEAL_NO} AS deal_no",
            "o_custkey AS client_id",
            "o_orderpriority AS portfolio_type",
            "CAST(o_orderkey % 25 AS INT) AS interest_rate",
        )

    def _dated(self, orders: DataFrame, *columns: str) -> DataFrame:
        """Each order at every snapshot date it existed, with its delay by then."""
        opened = _day("o_orderdate")
        return (
            orders.selectExpr("*", f"explode({_dates(SNAPSHOT_DATES)}) AS report_date")
            .where(f"{opened} <= report_date")
            .selectExpr(
                "*",
                f"least({BASE_DELAY}, CAST(datediff(report_date, {opened}) AS BIGINT)) AS dpd",
                "dpd div 30 AS bucket",
            )
            .selectExpr(*columns, "report_date", "dpd", "bucket")
        )

    @property
    def balances(self) -> DataFrame:
        principal = _share("o_totalprice", "0.02")
        nothing = "CAST(0 AS DECIMAL(18,4))"
        return self._dated(
            self.table("orders"),
            "o_orderkey AS deal_id",
            f"{principal} AS principal",
            f"{nothing} AS past_principal",
            f"{nothing} AS interest",
            f"{nothing} AS past_interest",
            f"{principal} AS outstanding",
        )

    def _card_orders(self) -> DataFrame:
        return self.table("orders").where("o_orderstatus = 'P'")

    @property
    def cards(self) -> DataFrame:
        return self._card_orders().selectExpr(
            "o_orderkey AS contract_id",
            f"{ORDER_TAX_ID} AS tax_id",
            "if(o_orderkey % 50 = 0, '', concat(o_orderkey, '  ')) AS contract_no",
            f"if(o_orderkey % 3 = 0, NULL, {_share('o_totalprice', '0.05')}) AS credit_limit",
            f"if(o_orderkey % 5 = 0, '{PREMIUM_CARD}', 'CC') AS subgroup",
        )

    @property
    def card_daily(self) -> DataFrame:
        return self._dated(self._card_orders(), "o_orderkey AS contract_id")

    @property
    def card_usage(self) -> DataFrame:
        return self.table("orders").where("o_orderpriority <> '5-LOW'").selectExpr(
            "o_orderkey AS contract_id", f"{_share('o_totalprice', '0.01')} AS outstanding"
        )

    @property
    def ledger_contracts(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS contract_id", f"{ORDER_TAX_ID} AS tax_id"
        )

    def _ledger(self, lines: DataFrame) -> DataFrame:
        suppliers = self.table("supplier").selectExpr(
            "s_suppkey AS l_suppkey", "s_nationkey AS currency"
        )
        return lines.join(suppliers, "l_suppkey").selectExpr(
            f"{_day('l_shipdate')} AS real_date",
            f"{_day('l_shipdate')} AS oper_date",
            "l_orderkey AS contract_id",
            f"{_money('l_extendedprice')} AS amount",
            "l_linenumber AS trans_id",
            "l_returnflag AS description",
            "currency",
        )

    @property
    def ledger_all(self) -> DataFrame:
        return self._ledger(self.table("lineitem"))

    @property
    def ledger_open(self) -> DataFrame:
        return self._ledger(self.table("lineitem").where("l_linestatus = 'O'"))

    @property
    def day_rates(self) -> DataFrame:
        first, last = RATE_DAYS
        return self.table("nation").selectExpr(
            f"explode(sequence(DATE '{first}', DATE '{last}')) AS oper_date",
            "n_nationkey AS ccy_from",
            "if(n_regionkey = 2, 'USD', 'UAH') AS ccy_to",
            f"{RATE} AS rate",
        )

    @property
    def latest_rates(self) -> DataFrame:
        return self.table("nation").where("n_regionkey <> 2").selectExpr(
            "n_nationkey AS currency_code",
            f"explode({_dates(RATE_DATES)}) AS rate_date",
            f"{RATE} AS rate",
        )

    @property
    def salary_wide(self) -> DataFrame:
        orders = self.table("orders").selectExpr(
            "o_orderkey AS l_orderkey",
            f"{ORDER_TAX_ID} AS tax_id",
            f"if(o_custkey % 4 = 0, DATE '{EARLY_REPORT}', DATE '{AS_OF}') AS report_date",
        )
        lines = self.table("lineitem").where("l_linestatus = 'F'").selectExpr(
            "l_orderkey",
            f"last_day({_day('l_shipdate')}) AS month",
            f"{_money('l_extendedprice')} AS amount",
        )
        months = orders.join(lines, "l_orderkey").selectExpr(
            "tax_id",
            "report_date",
            *[
                f"if(month = last_day(add_months(report_date, -{k})), amount, NULL) AS {name}"
                for k, name in enumerate(MONTH_COLS, start=1)
            ],
        )
        sums = months.groupBy("tax_id", "report_date").sum(*MONTH_COLS)
        return sums.selectExpr(
            "tax_id",
            "report_date",
            *[f"CAST(`sum({name})` AS DECIMAL(20,2)) AS {name}" for name in MONTH_COLS],
        )

    @property
    def clients(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS client_id", "lpad(CAST(c_custkey AS STRING), 10, '0') AS tax_id"
        )

    @property
    def schedule(self) -> DataFrame:
        price = _money("l_extendedprice")
        return self.table("lineitem").selectExpr(
            "l_orderkey AS deal_id",
            f"{_day('l_shipdate')} AS arc_date",
            "if(l_linestatus = 'O', 0, 1) AS status",
            f"{price} AS principal",
            f"CAST({price} * {_money('l_tax')} AS DECIMAL(14,2)) AS interest",
            f"CAST({price} * {_money('l_discount')} AS DECIMAL(14,2)) AS fee",
            f"{_money('l_quantity')} AS rest",
        )

    @property
    def deal_currency(self) -> DataFrame:
        customers = self.table("customer").selectExpr(
            "c_custkey AS o_custkey", "if(c_nationkey % 2 = 0, NULL, c_nationkey) AS currency_id"
        )
        return self.table("orders").join(customers, "o_custkey").selectExpr(
            f"{DEAL_NO} AS deal_no", "currency_id"
        )

    @property
    def vintage(self) -> DataFrame:
        opened = _day("o_orderdate")
        return self.table("orders").selectExpr(
            f"{ORDER_TAX_ID} AS tax_id",
            f"{DEAL_NO} AS deal_no",
            "o_orderkey AS deal_id",
            f"add_months({opened}, CAST(12 + o_orderkey % 60 AS INT)) AS expected_close",
            f"if(o_orderstatus = 'F', {opened}, NULL) AS close_date",
        )

    @property
    def large_requests(self) -> DataFrame:
        """Requests with incomes over all bands, the top bound and no income among them."""
        customers = self.table("customer").selectExpr(
            "c_custkey AS o_custkey",
            f"""CAST(CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 51 = 0 THEN 18000
                ELSE {_money('c_acctbal')} * 2 END AS DECIMAL(14,2)) AS income""",
        )
        return self.table("orders").join(customers, "o_custkey").selectExpr(
            "o_custkey AS client_id",
            f"{ORDER_TAX_ID} AS tax_id",
            "o_orderkey AS deal_id",
            "income",
            f"{_share('o_totalprice', '0.02')} AS payment",
            "if(o_orderstatus = 'P', 'Low', 'High') AS amount_type",
        )

    @property
    def iterations(self) -> DataFrame:
        return self.table("orders").selectExpr(
            f"{ORDER_TAX_ID} AS tax_id",
            "o_orderkey AS iteration_id",
            "o_orderkey % 7 AS order_no",
            "if(o_orderkey % 11 = 0, NULL, CAST(o_orderkey % 100 * 0.01BD AS DECIMAL(5,2))) AS dti",
            f"{_money('o_totalprice')} AS income",
        )

    @property
    def dated_publication(self) -> DataFrame:
        return self.dated_publication_of(F.lit(True))

    def dated_publication_of(self, orders: Column) -> DataFrame:
        return self.table("orders").where(orders).selectExpr(
            "o_custkey AS client_id", "last_day(o_orderdate) AS report_date"
        )

    @property
    def sessions(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS session_id",
            "concat('u', user_id % 10) AS login",
            "if(event_id % 5 = 0, NULL, event_id - event_id % 5) AS blocking_id",
            "if(event_id % 5 = 0, 4, 0) AS blocked_count",
            "event_type AS program",
            "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS start_time",
        )

    @property
    def badges(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "if(o_orderkey % 10 = 0, '   ', concat('  C', o_custkey, ' ')) AS badge",
            f"{_day('o_orderdate')} AS issued",
        )

    def month_wide(self, line_status: str) -> DataFrame:
        """Per client: first ship date and sum of each of the months before the as-of date."""
        orders = self.table("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey AS client_id")
        lines = self.table("lineitem").where(f"l_linestatus = '{line_status}'").selectExpr(
            "l_orderkey",
            f"{_day('l_shipdate')} AS day",
            f"last_day({_day('l_shipdate')}) AS month",
            f"{_money('l_extendedprice')} AS amount",
        )
        # one row per client and month first, so the shuffle to the wide form is narrow
        monthly = (
            orders.join(lines, "l_orderkey")
            .where(
                f"month BETWEEN DATE '{months_before(AS_OF, WIDE_MONTHS[-1])}' AND "
                f"DATE '{months_before(AS_OF, WIDE_MONTHS[0])}'"
            )
            .groupBy("client_id", "month")
            .agg({"day": "min", "amount": "sum"})
        )
        figures = []
        for k in WIDE_MONTHS:
            here = f"FILTER (WHERE month = DATE '{months_before(AS_OF, k)}')"
            figures.append(f"min(`min(day)`) {here} AS opened_{k}")
            figures.append(f"CAST(sum(`sum(amount)`) {here} AS DECIMAL(20,2)) AS limit_{k}")
        wide = self.spark.sql(
            f"SELECT client_id, {', '.join(figures)} FROM {{monthly}} GROUP BY client_id",
            monthly=monthly,
        )
        everyone = orders.join(lines, "l_orderkey").select("client_id").distinct()
        return everyone.join(wide, "client_id", "left")

    @property
    def order_lines(self) -> DataFrame:
        """Order details; the quantity of a seventh line is not known."""
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS part_id",
            "if(l_linenumber = 7, NULL, CAST(l_quantity AS DECIMAL(10,2))) AS quantity",
            f"{_money('l_extendedprice')} AS unit_price",
        )

    @property
    def order_headers(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CAST(if(o_orderpriority = '1-URGENT', 0.05BD, 0BD) AS DECIMAL(4,2)) AS discount",
            f"{_money('o_totalprice')} AS freight",
        )

    @property
    def faulty_headers(self) -> DataFrame:
        """An import with missing and unknown customers, repeated orders and bad amounts."""
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            """CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN -o_orderkey
               ELSE o_custkey END AS customer_id""",
            f"""if(o_orderkey % 103 = 0, concat('x', o_orderkey),
               CAST({_money('o_totalprice')} AS STRING)) AS amount_text""",
            "explode(sequence(1, if(o_orderkey % 101 = 0, 2, 1))) AS copy",
        )

    @property
    def faulty_details(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "if(l_orderkey % 107 = 0 AND l_linenumber = 1, -l_partkey - 1, l_partkey) AS part_id",
            "l_linenumber AS line_no",
            f"{_money('l_extendedprice')} AS amount",
        )

    @property
    def import_headers(self) -> DataFrame:
        """Headers with missing and unknown customers and repeated orders."""
        return self.order_headers.selectExpr(
            "order_id",
            """CASE WHEN order_id % 97 = 0 THEN NULL WHEN order_id % 89 = 0 THEN -order_id
               ELSE customer_id END AS customer_id""",
            "discount",
            "freight",
            "explode(sequence(1, if(order_id % 101 = 0, 2, 1))) AS copy",
        ).drop("copy")

    @property
    def import_lines(self) -> DataFrame:
        """Lines with some unknown parts; the quantity of a seventh line is not known."""
        return self.order_lines.withColumn(
            "part_id", F.expr("if(order_id % 107 = 0 AND part_id % 2 = 0, -part_id - 1, part_id)")
        )

    @property
    def price_lines(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS part_id",
            "l_linenumber AS line_no",
            "CAST(l_extendedprice AS DECIMAL(14,4)) AS unit_price",
        )

    @property
    def customer_orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_custkey AS customer_id",
            "o_orderkey AS order_id",
            f"{_day('o_orderdate')} AS order_date",
            f"{_money('o_totalprice')} AS amount",
        )

    @property
    def customer_names(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS customer_id", "c_name AS customer_name"
        )
