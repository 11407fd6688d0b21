from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyworks.functions import dates
from tallyworks.operators import classes, exposure, gate, income, payments

D = Decimal


def test_month_helpers():
    assert dates.previous_month_end(dt.date(2001, 1, 15)) == dt.date(2000, 12, 31)
    assert dates.month_end(dt.date(2000, 2, 3)) == dt.date(2000, 2, 29)
    assert dates.months_before(dt.date(2001, 7, 31), 6) == dt.date(2001, 1, 31)


@pytest.mark.parametrize(
    ("start", "end", "months"),
    [("2001-02-28", "2001-03-01", 1), ("2001-03-01", "2001-03-31", 0), ("2001-01-31", "2000-12-01", -1)],
)
def test_month_boundaries(rows, start, end, months):
    df = rows("a string, b string", (start, end)).select(
        dates.month_boundaries(F.to_date("a"), F.to_date("b")).alias("n")
    )
    assert df.first()["n"] == months


PROFILE = "client_id long, tax_id string, debt decimal(20,2), dpd long, income double, payment decimal(25,4)"


@pytest.mark.parametrize(
    ("dpd", "payment", "expected"),
    [
        (7, "49.99", (1, 2648)),
        (8, "49.99", (2, 1986)),
        (7, "50", (2, 1986)),
        (30, "59.99", (2, 1986)),
        (31, "59.99", (3, 1324)),
        (60, "69.99", (3, 1324)),
        (61, "69.99", (4, 662)),
        (90, "79.99", (4, 662)),
        (91, "1", (5, 0)),
        (0, "80", (5, 0)),
        (None, None, (1, 2648)),
    ],
)
def test_class_ladder(rows, dpd, payment, expected):
    df = rows(PROFILE, (1, "1", D(1), dpd, 100.0, payment and D(payment)))
    row = classes.risk_class(df).first()
    assert (row["class"], row["score"]) == expected


@pytest.mark.parametrize("no_income", [None, 0.0])
def test_no_income_is_worst(rows, no_income):
    row = classes.risk_class(rows(PROFILE, (1, "1", D(1), 0, no_income, D(1)))).first()
    assert (row["class"], row["score"], row["dti"], row["income"]) == (5, 0, 0.0, 0.0)


@pytest.mark.parametrize(
    ("earned", "paid", "expected"),
    [
        (2499, 1, 4), (2500, 999, 3), (2500, 1000, 4), (3000, 899, 2), (3000, 900, 3),
        (3499, 1749, 3), (3500, 1749, 2), (5000, 2999, 2), (10000, 7000, 3), (10000, 8000, 4),
        (17999, 100, 2), (18000, 1, 4), (18001, 14000, 2), (18001, 14500, 3), (None, 1, 4),
    ],
)
def test_income_bands(rows, earned, paid, expected):
    df = rows(
        "client_id long, tax_id string, deal_id long, income decimal(14,2), "
        "payment decimal(14,2), amount_type string",
        (1, "1", 1, earned and D(earned), D(paid), "High"),
        (2, "2", 2, D(1), D(1), "Low"),
    )
    assert [row["class"] for row in classes.high_income_class(df).collect()] == [expected]


def test_report_text_and_back(rows):
    df = rows(PROFILE, (1, "0000000001", D("1000000.5"), 3, 300.0, D("30.456")))
    report = classes.publish_report(classes.risk_class(df), dt.date(2001, 8, 5))
    row = report.first()
    assert row["report_date"] == "05 Aug 2001"
    assert row["parameters"] == "Income=300.00;Payment=30.46;DTI=0.10;DPD=3;Sum_dolg=1000000.50;"
    assert row["score"] == "DTI_DPD=2648;"
    back = classes.parse_parameters(report, "parameters", "Sum_dolg").first()
    assert back["value"] == 1000000.5
    assert classes.parse_parameters(report, "parameters", "absent").first()["value"] is None


def test_latest_publication_numbers_from_highest(rows):
    report = rows(
        "report_date string, client_id long, tax_id string, class int",
        ("31 Dec 2000", 9, "9", 1), ("01 Feb 2001", 1, "1", 2), ("01 Feb 2001", 2, "2", 3),
    )
    numbered = classes.latest_publication(report).select("client_id", "rn")
    assert as_set(numbered) == [(1, 2), (2, 1)]


LEDGER = (
    "real_date date, oper_date date, contract_id long, amount decimal(14,2), trans_id int, "
    "description string, currency int"
)


@pytest.mark.parametrize(("closed", "total"), [("right", 11), ("left", 14)])
def test_turnover_window_ends(rows, closed, total):
    lo, mid, hi = dt.date(2001, 1, 31), dt.date(2001, 2, 5), dt.date(2001, 7, 31)
    ledger = rows(
        LEDGER,
        (lo, lo, 1, D(4), 1, "A", 1), (mid, mid, 1, D(10), 1, "A", 1), (hi, hi, 1, D(1), 1, "A", 1),
        (mid, mid, 1, D(100), 4, "A", 1), (mid, mid, 1, D(100), 1, "B", 1),
        (mid, mid, 1, D(100), 1, "A", 2), (mid, mid, 2, D(100), 1, "A", 1),
    )
    contracts = rows("contract_id long, tax_id string", (1, "1"), (2, "0000000000"), (1, None))
    rates = rows(
        "oper_date date, ccy_from int, ccy_to string, rate decimal(10,4)",
        *[(day, 1, "UAH", D(1)) for day in (lo, mid, hi)], (mid, 2, "USD", D(1)),
    )
    df = income.salary_turnover(ledger, contracts, rates, lo, hi, closed)
    assert as_set(df) == [("1", D(total))]


def test_equal_salaries_count_once(rows):
    first = rows("tax_id string, salary decimal(24,6)", ("1", D(6)), ("2", D(6)))
    second = rows("tax_id string, salary decimal(24,6)", ("1", D(6)), ("2", D(7)))
    merged = income.salary_union(first, second)
    assert as_set(income.avg_income([merged])) == [("1", 1.0), ("2", 13 / 6)]


MONTHS = [f"m{k}" for k in range(1, 7)]
WIDE = "tax_id string, report_date date, " + ", ".join(f"{m} decimal(10,2)" for m in MONTHS)


def test_unpivot_sum_zeroes_early_months(rows):
    day = dt.date(2001, 6, 15)
    wide = rows(
        WIDE,
        ("1", day, D(1), None, D(3), D(4), D(5), D(6)),
        ("2", day, None, None, None, None, None, D(6)),
        ("9999999999", day, *[D(1)] * 6),
    )
    # month ends: May, Apr, Mar, Feb, Jan, Dec; December ends before the window
    df = income.salary_unpivot_sum(wide, MONTHS, dt.date(2001, 1, 31))
    assert as_set(df) == [("1", D(13))]


def test_unpivot_avg_needs_recent_and_three_months(rows):
    day = dt.date(2001, 6, 15)
    wide = rows(
        WIDE,
        ("1", day, D(1), None, None, D(2), D(4), None),
        ("2", day, D(1), None, None, D(2), None, None),
        ("3", day, None, None, None, D(1), D(1), D(1)),
        ("4", day, D(0), D(5), None, D(5), D(5), None),
    )
    assert as_set(income.salary_unpivot_avg(wide, MONTHS)) == [("1", D("2.33"))]


def test_due_window_is_open_on_both_ends(rows):
    as_of = dt.date(2001, 8, 15)
    days = [as_of + dt.timedelta(days=n) for n in (-31, -30, 30, 31)]
    money = "decimal(14,2)"
    schedule = rows(
        f"deal_id long, arc_date date, status int, principal {money}, interest {money}, "
        f"fee {money}, rest {money}",
        *[(1, day, 0, D(100), D(10), D(1), D(0)) for day in days],
        (1, as_of, 1, D(100), D(10), D(1), D(0)),
        (1, as_of, 0, D(100), None, D(1), D(0)),
    )
    df = payments.due_payments(
        rows("client_id long, tax_id string", (7, "7")),
        rows("deal_id long, deal_no string, client_id long", (1, "D1", 7)),
        schedule,
        rows("deal_no string, currency_id int", ("D1", None)),
        as_of,
    )
    got = [(row["arc_date"], row["rn"], row["pay"]) for row in df.orderBy("rn").collect()]
    assert got == [(days[1], 1, D("1.1100")), (as_of, 2, None), (days[2], 3, D("1.1100"))]


def test_fx_uses_newest_rates_only(rows):
    rates = rows(
        "currency_code int, rate_date date, rate decimal(10,4)",
        (1, dt.date(2001, 7, 30), D(9)), (1, dt.date(2001, 7, 31), D("1.5")),
        (2, dt.date(2001, 7, 30), D(2)),
    )
    df = rows("currency_id int, pay decimal(19,4)", (None, D("1.005")), (1, D("1.03")), (2, D(1)))
    out = payments.fx_latest_convert(df, rates, "pay", "currency_id").orderBy("currency_id")
    assert [row["payment"] for row in out.collect()] == [D("1.005"), D("1.55"), None]


def test_annuity(rows):
    df = rows(
        "tax_id string, deal_no string, deal_id long, principal decimal(18,4), "
        "interest_rate int, term int",
        ("1", "a", 1, D(1200), 0, 12), ("1", "b", 2, D(1000), 12, 12), ("1", "c", 3, D(1), 5, None),
    )
    got = {row["deal_no"]: row["payment"] for row in payments.annuity_payment(df).collect()}
    assert got == {"a": D(100), "b": D("88.85"), "c": None}


def test_term_is_at_least_one_month(rows):
    day, zero = dt.date(2001, 7, 31), D(0)
    vintage = rows(
        "tax_id string, deal_no string, deal_id long, expected_close date, close_date date",
        ("1", "a", 1, dt.date(2001, 7, 1), None), ("1", "b", 2, dt.date(2001, 8, 1), None),
        ("1", "c", 3, dt.date(2003, 7, 1), None), ("1", "paid", 4, day, None),
        ("1", "closed", 5, day, day), ("1", "null", 6, day, None),
    )
    money = "decimal(18,4)"
    balances = rows(
        f"deal_id long, report_date date, principal {money}, past_principal {money}, "
        f"interest {money}, past_interest {money}, outstanding {money}",
        *[(k, day, D(10), zero, zero, zero, D(10)) for k in range(1, 6)],
        (6, day, D(10), None, zero, zero, D(10)),
    )
    deals = rows("deal_id long, interest_rate int", (1, 7))
    paid = rows("deal_no string", ("paid",))
    df = payments.deals_without_schedule(vintage, deals, paid, balances, day)
    assert as_set(df.select("deal_no", "interest_rate", "term")) == [
        ("a", 7, 1), ("b", 0, 1), ("c", 0, 24),
    ]


def test_card_minimum(rows):
    cards = rows(
        "contract_id long, tax_id string, contract_no string, credit_limit decimal(18,4), "
        "subgroup string",
        (1, "1", "x", D(100), "CC"), (2, "1", "x", D(100), "GOLD"), (3, "1", "x", None, "CC"),
        (4, "1", "x", D(0), "GOLD"), (5, "1", "x", None, "CC"), (6, None, "x", D(1), "CC"),
    )
    usage = rows("contract_id long, outstanding decimal(18,4)", (3, D(40)), (4, D(40)), (1, D(9)))
    df = payments.card_min_payment(cards, usage, "GOLD").select("deal_id", "payment")
    assert as_set(df) == [(1, D(5)), (2, D(10)), (3, D(2)), (4, D(4))]


EXPOSURE = "client_id long, tax_id string, deal_id long, source_deal_no string, source_dpd long, debt decimal(20,2)"


@pytest.mark.parametrize("salts", [8, 1, 3])
def test_contract_match_finds_every_pair(spark, rows, salts):
    deals = [(1, t, i, f"D{i}-{t}", 0, D(1)) for t in ("7", "8") for i in (1, 11, 112, 1121, 30)]
    contracts = [
        (10, "7", "11  ", D(1)), (11, "7", "112", D(1)), (12, "7", "  ", D(1)), (13, "7", "", D(1)),
        (14, "7", "D1121-7", D(1)), (15, "8", "1", D(1)), (16, "9", "1", D(1)),
        (17, "7", "longer than any deal number", D(1)), (18, "8", "%", D(1)), (19, "7", "11", D(1)),
    ]
    got = exposure.contract_text_match(
        rows(EXPOSURE, *deals),
        rows("contract_id long, tax_id string, contract_no string, credit_limit decimal(18,4)", *contracts),
        salts=salts,
    ).select("deal_id", "tax_id", "contract_id")
    expected = sorted(
        (d[2], d[1], c[0])
        for d in deals for c in contracts
        if d[1] == c[1] and c[2].rstrip(" ") and c[2].rstrip(" ") in d[3]
    )
    assert as_set(got) == expected and expected


def test_gate_order_and_empty_target(rows):
    as_of = dt.date(2001, 1, 15)
    ledger = rows("real_date date", (dt.date(2000, 12, 31),), (dt.date(2000, 12, 1),))
    source = rows("report_date date", (dt.date(2000, 12, 31),))
    published = rows("report_date date", (dt.date(2000, 12, 15),))
    loaded = rows("input_date date", (dt.date(2000, 12, 15),))
    nothing = rows("input_date date")

    def outcome(*tables):
        return gate.gate_outcome(gate.readiness_gate(*tables, as_of)).first()["outcome"]

    assert outcome(ledger, source, loaded, published) == "run"
    assert outcome(rows("real_date date", (dt.date(2000, 12, 30),)), source, loaded, published) == (
        "incomplete ledger"
    )
    assert outcome(ledger, rows("report_date date"), loaded, published) == "missing source"
    assert outcome(ledger, source, nothing, published) == "already done"
    wrong = rows("report_date date", (as_of,))
    with pytest.raises(Exception, match="expected 2000-12-31"):
        gate.assert_snapshot_date(wrong, "report_date", as_of).collect()


def test_substrings_of_no_contract_are_dropped_before_the_join(rows):
    """Clients with one number and with many; the plan tests marks before it sends the pieces."""
    numbers = [("a", 1, "777")] + [("b", 100 + i, f"{i:03d}") for i in range(150)]
    deals = [("a", i, f"{i:05d}") for i in range(76_900, 77_900, 7)] + [("b", i, f"x{i}x") for i in range(0, 400, 3)]
    got = exposure.contract_text_match(
        rows("tax_id string, deal_id int, source_deal_no string", *deals),
        rows("tax_id string, contract_id int, contract_no string, credit_limit int", *[(*n, 1) for n in numbers]),
    )
    wanted = sorted({(d, c) for t, d, text in deals for u, c, no in numbers if t == u and no in text})
    assert sorted({(r.deal_id, r.contract_id) for r in got.collect()}) == wanted and len(wanted) > 20
    assert "_marks" in got._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
