"""The runnable queries: every operator on the role tables of one data folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions import text
from tallyworks.functions.values import money
from tallyworks.operators import (
    accumulators,
    classes,
    copy_jobs,
    exposure,
    gate,
    income,
    key_ranges,
    keys,
    lists,
    loading,
    lookups,
    numbering,
    payments,
    stored_jobs,
)
from tallyworks.plans.bindings import (
    AS_OF,
    MAX_DATE,
    MIN_DATE,
    MONTH_COLS,
    PREMIUM_CARD,
    WIDE_MONTHS,
    Roles,
)
from tallyworks.plans.risk import RiskReport, RiskSources
from tallyworks.sources.sinks import PUBLISHED, publish_rows, read_publication
from tallyworks.sources.storage import freeze, scratch_path
from tallyworks.sources.stored import TableStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EARLIER = dt.date(2001, 7, 15)
SESSION_TIME = dt.datetime(2024, 1, 5, 21, 0)
WINNERS, EXEMPT = ("u1", "u2"), ("u3",)
PRODUCT_PATTERNS = ("%red%", "hot%", "%gear", "b_ue%", "%#1", "small%Brand#2%", "%2%nut%")


def portable(df: DataFrame) -> DataFrame:
    """Plain column types, the same whichever engine computed them."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("long")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def query(build: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(Roles(spark, folder)))

    QUERIES[build.__name__] = run
    return build


def risk_sources(r: Roles) -> RiskSources:
    return RiskSources(
        portfolio=r.portfolio,
        deals=r.deals,
        balances=r.balances,
        cards=r.cards,
        card_daily=r.card_daily,
        card_usage=r.card_usage,
        contracts=r.ledger_contracts,
        first_ledger=r.ledger_all,
        second_ledger=r.ledger_open,
        day_rates=r.day_rates,
        latest_rates=r.latest_rates,
        salary_wide=r.salary_wide,
        month_cols=MONTH_COLS,
        premium_card=PREMIUM_CARD,
        clients=r.clients,
        schedule=r.schedule,
        deal_currency=r.deal_currency,
        vintage=r.vintage,
    )


def risk_report(r: Roles) -> RiskReport:
    return RiskReport(risk_sources(r), AS_OF)


def new_store(r: Roles, **tables: tuple[DataFrame, str]) -> TableStore:
    """A store of its own with tables laid out by key."""
    store = TableStore(r.spark, scratch_path(r.spark, "store"))
    for name, (df, key) in tables.items():
        stored_jobs.store_table(store, name, df, key)
    return store


# --- client risk report ---------------------------------------------------------


@query
def readiness_gate(r: Roles) -> DataFrame:
    published = r.dated_publication
    newest = published.agg(F.max("report_date")).scalar()
    target = published.where(F.col("report_date") == newest).withColumnRenamed(
        "report_date", "input_date"
    )
    return gate.readiness_gate(r.ledger_all, r.portfolio, target, published, AS_OF)


@query
def readiness_gate_short(r: Roles) -> DataFrame:
    """The target holds only part of the last publication: its count fails."""
    published = r.dated_publication
    newest = published.agg(F.max("report_date")).scalar()
    held = r.dated_publication_of(F.col("o_orderstatus") == "O").withColumnRenamed("report_date", "input_date")
    target = held.where(F.col("input_date") == newest)
    return gate.readiness_gate(r.ledger_all, r.portfolio, target, published, AS_OF)


@query
def gate_outcome(r: Roles) -> DataFrame:
    return gate.gate_outcome(readiness_gate(r))


@query
def gate_outcome_short(r: Roles) -> DataFrame:
    return gate.gate_outcome(readiness_gate_short(r))


@query
def assert_snapshot_date(r: Roles) -> DataFrame:
    checked = gate.assert_snapshot_date(r.portfolio, "report_date", AS_OF)
    return checked.groupBy("report_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def exposure_rollup(r: Roles) -> DataFrame:
    return exposure.exposure_rollup(r.portfolio)


@query
def snapshot_as_of(r: Roles) -> DataFrame:
    return exposure.snapshot_as_of(r.balances, "report_date", AS_OF)


@query
def deal_enrich(r: Roles) -> DataFrame:
    snapshot = exposure.snapshot_as_of(r.balances, "report_date", AS_OF)
    return exposure.deal_enrich(exposure.exposure_rollup(r.portfolio), r.deals, snapshot)


@query
def contract_text_match(r: Roles) -> DataFrame:
    return exposure.contract_text_match(exposure.exposure_rollup(r.portfolio), r.cards)


@query
def card_snapshot(r: Roles) -> DataFrame:
    return exposure.card_enrich(
        contract_text_match(r), exposure.card_snapshot(r.card_daily, r.cards, AS_OF)
    )


@query
def portfolio_union(r: Roles) -> DataFrame:
    return risk_report(r).credit_portfolio(exposure.exposure_rollup(r.portfolio))


@query
def client_exposure(r: Roles) -> DataFrame:
    return risk_report(r).client_debts()


def _turnover(r: Roles, first: bool) -> DataFrame:
    return income.salary_turnover(
        r.ledger_all if first else r.ledger_open,
        r.ledger_contracts,
        r.day_rates,
        MIN_DATE,
        MAX_DATE,
        "right" if first else "left",
    )


@query
def salary_turnover(r: Roles) -> DataFrame:
    return _turnover(r, True)


@query
def salary_turnover_left_closed(r: Roles) -> DataFrame:
    return _turnover(r, False)


@query
def salary_union(r: Roles) -> DataFrame:
    return income.salary_union(_turnover(r, False), _turnover(r, True))


@query
def salary_unpivot_sum(r: Roles) -> DataFrame:
    return income.salary_unpivot_sum(r.salary_wide, MONTH_COLS, MIN_DATE)


@query
def avg_income(r: Roles) -> DataFrame:
    return risk_report(r).income()


@query
def due_payments(r: Roles) -> DataFrame:
    return payments.due_payments(r.clients, r.deals, r.schedule, r.deal_currency, AS_OF)


@query
def fx_latest_convert(r: Roles) -> DataFrame:
    due = payments.due_payments(
        r.clients, r.deals, r.schedule, r.deal_currency, AS_OF, numbered=False
    )
    return payments.fx_latest_convert(due, r.latest_rates, "pay", "currency_id").select(
        "tax_id", "deal_no", "currency_id", "pay", "payment"
    )


@query
def deal_payment_max(r: Roles) -> DataFrame:
    return risk_report(r).scheduled()


def _unscheduled(r: Roles) -> DataFrame:
    report = risk_report(r)
    return payments.deals_without_schedule(
        r.vintage, r.deals, report.scheduled(), r.balances, report.snapshot_date()
    )


@query
def deals_without_schedule(r: Roles) -> DataFrame:
    return _unscheduled(r)


@query
def annuity_payment(r: Roles) -> DataFrame:
    return payments.annuity_payment(_unscheduled(r))


@query
def card_min_payment(r: Roles) -> DataFrame:
    return payments.card_min_payment(r.cards, r.card_usage, PREMIUM_CARD)


@query
def payments_by_client(r: Roles) -> DataFrame:
    return risk_report(r).payments()


@query
def client_profile(r: Roles) -> DataFrame:
    return risk_report(r).profile()


@query
def risk_class(r: Roles) -> DataFrame:
    return risk_report(r).classes()


@query
def client_risk_report(r: Roles) -> DataFrame:
    return risk_report(r).report()


def _classes(r: Roles) -> DataFrame:
    """Classes of the whole report, stored: several publications read them."""
    return freeze(risk_report(r).classes(), "classes")


def _published(r: Roles) -> str:
    """A folder with two publications; the second is published twice, as by a restarted job."""
    path, rows = scratch_path(r.spark, "report"), _classes(r)
    for day in (EARLIER, AS_OF, AS_OF):
        publish_rows(classes.publish_report(rows, day), path, day)
    return path


def _two_reports(r: Roles) -> DataFrame:
    rows = _classes(r)
    return classes.publish_report(rows, EARLIER).unionByName(classes.publish_report(rows, AS_OF))


@query
def publish_report(r: Roles) -> DataFrame:
    return r.spark.read.parquet(_published(r)).drop(PUBLISHED)


@query
def parse_parameters(r: Roles) -> DataFrame:
    report = classes.publish_report(_classes(r), AS_OF)
    for key in ("Income", "DTI", "DPD", "Sum_dolg"):
        report = classes.parse_parameters(report, "parameters", key, key.lower())
    return report.where(F.col("class") != 5).select(
        "client_id", "income", "dti", "dpd", "sum_dolg"
    )


@query
def latest_publication(r: Roles) -> DataFrame:
    return classes.numbered_publication(read_publication(r.spark, _published(r)))


@query
def latest_publication_by_date(r: Roles) -> DataFrame:
    """The same from one frame of all publications."""
    return classes.latest_publication(_two_reports(r))


def _exported(r: Roles) -> tuple[TableStore, DataFrame]:
    """An export of the earlier publication, replaced by the newest one; the second run starts twice."""
    path, store = _published(r), new_store(r)
    order = [F.col("client_id").desc(), "tax_id"]
    for day in (EARLIER, AS_OF, AS_OF):
        rows = classes.exported_columns(read_publication(r.spark, path, day))
        counts = stored_jobs.export_in_slices(store, "export", rows, order, f"export {day}", 1000)
    return store, counts


@query
def replace_export(r: Roles) -> DataFrame:
    return _exported(r)[1]


@query
def exported_rows(r: Roles) -> DataFrame:
    return _exported(r)[0].read("export").drop("tax_id")


@query
def export_slices_by_date(r: Roles) -> DataFrame:
    numbered = numbering.number_rows(
        _two_reports(r), ["client_id", "tax_id"], "rn", within=["report_date"]
    )
    return numbering.slices(numbered, 1000)


@query
def high_income_class(r: Roles) -> DataFrame:
    return classes.high_income_class(r.large_requests)


@query
def salary_unpivot_avg(r: Roles) -> DataFrame:
    return income.salary_unpivot_avg(r.salary_wide, MONTH_COLS)


@query
def latest_iteration_per_key(r: Roles) -> DataFrame:
    return classes.latest_iteration_per_key(r.iterations)


@query
def report_qc(r: Roles) -> DataFrame:
    report = _two_reports(r)
    day = F.to_date("report_date", "dd MMM yyyy")
    return classes.report_qc(report, report.where(day == F.lit(AS_OF)), dense=1)


@query
def report_top(r: Roles) -> DataFrame:
    rows = risk_report(r).credit_portfolio(exposure.exposure_rollup(r.portfolio))
    order = [F.col("deal_id"), F.col("linked_no").desc(), F.col("linked_id").desc()]
    return classes.report_top(rows, F.col("credit_source") == "CC", order, 10000)


# --- query recipes --------------------------------------------------------------


@query
def listagg_by_group(r: Roles) -> DataFrame:
    return lists.listagg_by_group(r.table("orders"), "o_custkey", "o_orderpriority")


@query
def listagg_distinct_by_group(r: Roles) -> DataFrame:
    pairs = lists.distinct_pairs(r.table("orders"), "o_custkey", "o_orderpriority")
    return lists.listagg_by_group(pairs, "o_custkey", "o_orderpriority")


@query
def listagg_top_n(r: Roles) -> DataFrame:
    return lists.listagg_top_n(r.table("part"), "p_name", 10, ["p_brand", "p_partkey"])


@query
def distinct_pairs(r: Roles) -> DataFrame:
    return lists.distinct_pairs(r.table("orders"), "o_custkey", "o_orderstatus")


@query
def overlay_text(r: Roles) -> DataFrame:
    name = F.col("p_name")
    return r.table("part").select(
        "p_partkey",
        text.overlay_text(name, 3, 2, "000").alias("replaced"),
        text.overlay_text(name, 1, 1, "").alias("cut"),
    )


@query
def insert_new_keys(r: Roles) -> DataFrame:
    incoming = r.badges
    split = F.lit(dt.date(1998, 1, 1))
    empty = r.spark.createDataFrame([], "badge_id long, badge string")
    first = keys.insert_new_keys(
        empty, incoming.where(F.col("issued") < split), "badge", "badge_id"
    )
    return keys.insert_new_keys(
        first, incoming.where(F.col("issued") >= split), "badge", "badge_id"
    )


@query
def blocking_pairs(r: Roles) -> DataFrame:
    return keys.blocking_pairs(r.sessions, WINNERS, EXEMPT, SESSION_TIME)


@query
def flag_log(r: Roles) -> DataFrame:
    pairs = keys.blocking_pairs(r.sessions, WINNERS, EXEMPT, SESSION_TIME)
    return keys.flag_log(r.sessions, pairs, SESSION_TIME)


@query
def split_trim(r: Roles) -> DataFrame:
    return lists.split_trim(r.table("documents").select("doc_id", "text"), "text", ",").select(
        "doc_id", "item"
    )


@query
def sum_columns_from_list(r: Roles) -> DataFrame:
    names = lists.names_from_list("[l_quantity],[l_extendedprice],[l_discount]")
    lines = r.table("lineitem").select(*[money(F.col(name)).alias(name) for name in names])
    return lists.sum_columns_from_list(lines, names)


@query
def like_literal(r: Roles) -> DataFrame:
    return lookups.like_literal(r.table("documents"), "text", "%").select("doc_id", "source")


def _employees(r: Roles) -> DataFrame:
    return r.table("customer").select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        (F.col("c_nationkey") % 5).alias("department_id"),
        (F.col("c_nationkey") % 7).alias("position_id"),
    )


@query
def case_sort(r: Roles) -> DataFrame:
    return lookups.case_sort(_employees(r), "c_acctbal", 2500, "c_name").select(
        "c_custkey", "c_name", "c_acctbal"
    )


@query
def nested_case(r: Roles) -> DataFrame:
    steps = [
        (F.col("department_id").isin(1, 2), "desk"),
        (F.col("department_id") == 3, ("position_id", {3: "field-1", 4: "field-2"})),
    ]
    return lookups.nested_case(_employees(r), steps, "other", "grade")


@query
def undefined_products(r: Roles) -> DataFrame:
    parts = r.table("part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws(" ", "p_name", "p_brand").alias("name"),
        "p_type",
    )
    sold = r.table("lineitem").select("l_partkey", "l_shipdate").join(parts, "l_partkey")
    return lookups.undefined_products(
        sold, "name", "l_shipdate", PRODUCT_PATTERNS, F.col("p_type") == "PROMO"
    )


@query
def max_text_length(r: Roles) -> DataFrame:
    return lookups.max_text_length(r.table("documents"), "text")


@query
def coalesce_wide(r: Roles) -> DataFrame:
    return keys.coalesce_wide(
        r.month_wide("O"), r.month_wide("F"), "client_id", WIDE_MONTHS, ["opened_{}"], ["limit_{}"]
    )


@query
def longest_streak(r: Roles) -> DataFrame:
    return keys.longest_streak(r.table("events"), ["user_id", "event_type"], "ts")


@query
def max_per_table(r: Roles) -> DataFrame:
    frames = {
        "temp1_orders": r.table("orders").withColumnRenamed("o_orderdate", "enrolled_on"),
        "temp2_lineitem": r.table("lineitem").withColumnRenamed("l_shipdate", "enrolled_on"),
        "temp3_events": r.table("events").withColumnRenamed("ts", "date_enrolled"),
        "temp4_parts": r.table("part"),
        "orders": r.table("orders").withColumnRenamed("o_orderdate", "enrolled_on"),
    }
    return keys.max_per_table(frames, r"temp[0-9]_.*", "enrolled")


@query
def definition_search(r: Roles) -> DataFrame:
    return lookups.definition_search(
        r.table("documents"), r.table("labels"), "doc_id", "text", "%ing%the%", ["doc_id", "quality"]
    )


@query
def star_denormalize(r: Roles) -> DataFrame:
    return lookups.star_denormalize(
        r.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
        ),
        [
            (r.table("orders"), "l_orderkey", "o_orderkey",
             {"o_orderpriority": "order_priority", "o_orderstatus": "order_status"}),
            (r.table("part"), "l_partkey", "p_partkey", {"p_name": "part_name"}),
            (r.table("supplier"), "l_suppkey", "s_suppkey", {"s_name": "supplier_name"}),
        ],
    )


@query
def day_slice(r: Roles) -> DataFrame:
    return lookups.day_slice(
        r.table("orders"), "o_orderstatus", "F", "o_orderdate",
        dt.date(1998, 3, 1), dt.date(1998, 3, 2),
    )


@query
def point_lookup(r: Roles) -> DataFrame:
    return lookups.point_lookup(
        r.table("orders"), "o_orderpriority", "1-URGENT", ["o_orderkey", "o_custkey"]
    )


@query
def point_lookup_all(r: Roles) -> DataFrame:
    return lookups.point_lookup(r.table("orders"), "o_orderpriority", "1-URGENT")


@query
def top_rows(r: Roles) -> DataFrame:
    return lookups.top_rows(
        r.table("orders"), ["o_orderkey", "o_custkey", "o_orderpriority"], 100, ["o_orderkey"]
    )


@query
def scan_all(r: Roles) -> DataFrame:
    return lookups.scan_all(r.table("orders"))


# --- batch jobs -----------------------------------------------------------------


def _order_keys(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey")


@query
def assign_batches(r: Roles) -> DataFrame:
    return numbering.assign_batches(_order_keys(r), "o_orderkey", 1000)


@query
def assign_batches_purge(r: Roles) -> DataFrame:
    return numbering.assign_batches(_order_keys(r), "o_orderkey", 1000, offset=0)


@query
def split_batch(r: Roles) -> DataFrame:
    batches = numbering.assign_batches(_order_keys(r), "o_orderkey", 1000)
    return numbering.split_batch(batches, 3, "o_orderkey")


@query
def key_range_batches(r: Roles) -> DataFrame:
    return key_ranges.key_range_batches(r.table("lineitem"), "l_orderkey", 1000)


@query
def key_range_batches_unique(r: Roles) -> DataFrame:
    return key_ranges.key_range_batches(r.table("orders"), "o_orderkey", 1000, unique=True)


@query
def fixed_stride_batches(r: Roles) -> DataFrame:
    return key_ranges.fixed_stride_batches(r.table("lineitem"), "l_orderkey", 700)


@query
def copy_table(r: Roles) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    return copy_jobs.copy_table(r.table("lineitem"), scratch_path(r.spark, "copy"), columns)


@query
def resumable_copy(r: Roles) -> DataFrame:
    source = r.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    root = scratch_path(r.spark, "copy")
    low, high = source.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    stopped = source.where(F.col("o_orderkey") <= (low + high) // 2)
    copy_jobs.resumable_copy(stopped, root, "o_orderkey")
    return copy_jobs.resumable_copy(source, root, "o_orderkey")


@query
def purge_before(r: Roles) -> DataFrame:
    return copy_jobs.purge_before(r.table("orders"), "o_orderdate", dt.date(1998, 1, 1)).select(
        "o_orderkey", "o_orderdate"
    )


def _fillable(r: Roles) -> DataFrame:
    old = F.col("l_shipdate") < F.lit(dt.date(1996, 1, 1))
    return r.table("lineitem").select(
        "l_orderkey", "l_partkey", F.when(old, "kept").otherwise("").alias("filler")
    )


@query
def fill_unset(r: Roles) -> DataFrame:
    value = F.md5(F.col("l_orderkey").cast("string"))
    return copy_jobs.fill_unset(_fillable(r), "l_orderkey", "filler", value)


@query
def fill_unset_all(r: Roles) -> DataFrame:
    value = F.md5(F.col("l_orderkey").cast("string"))
    return copy_jobs.fill_unset(_fillable(r), "l_orderkey", "filler", value, resume=False)


@query
def reprice_once(r: Roles) -> DataFrame:
    lines = r.price_lines
    root = scratch_path(r.spark, "reprice")
    middle = lines.agg(F.floor(F.avg("order_id")).cast("long")).first()[0]
    job = ("order_id", "unit_price", Decimal("1.2"), root, "rise")
    copy_jobs.reprice_once(lines, *job, upto=middle)
    return copy_jobs.reprice_once(lines, *job)


@query
def stored_purge(r: Roles) -> DataFrame:
    """Old orders deleted from a stored table, the job stopped half way and started again."""
    store = new_store(r, orders=(r.table("orders").select("o_orderkey", "o_orderdate"), "o_orderkey"))
    job = ("orders", "o_orderdate", dt.date(1998, 1, 1), "purge")
    stored_jobs.purge_stored(store, *job, files_per_step=4)
    stored_jobs.purge_stored(store, *job)
    return store.read("orders")


@query
def stored_fill_unset(r: Roles) -> DataFrame:
    store = new_store(r, lines=(_fillable(r), "l_orderkey"))
    value = F.md5(F.col("l_orderkey").cast("string"))
    stored_jobs.fill_stored(store, "lines", "l_orderkey", "filler", value, "fill")
    return store.read("lines")


@query
def stored_reprice(r: Roles) -> DataFrame:
    """Prices raised once, though the job is started twice."""
    store = new_store(r, lines=(r.price_lines, "order_id"))
    for _ in range(2):
        stored_jobs.reprice_stored(store, "lines", "unit_price", Decimal("1.2"), "rise", files_per_step=4)
    return store.read("lines")


@query
def stored_unload(r: Roles) -> DataFrame:
    """Order lines left after a batch of orders went from headers and lines in one commit."""
    store = new_store(
        r,
        headers=(r.table("orders").select(F.col("o_orderkey").alias("order_id"), "o_orderpriority"), "order_id"),
        lines=(r.table("lineitem").select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_linenumber"), "order_id"),
    )
    batch = store.read("headers").where(F.col("o_orderpriority") == "1-URGENT")
    stored_jobs.unload_stored(store, ["headers", "lines"], batch, "order_id", "unload")
    left = store.read("lines").join(store.read("headers").select("order_id"), "order_id", "left_semi")
    return left.withColumnRenamed("order_id", "l_orderkey")


def _loaded_twice(r: Roles) -> TableStore:
    """A third of an import loaded by one run, then the whole import by a second one."""
    store = new_store(r)
    for job, headers in (("first", r.import_headers.where(F.col("order_id") % 3 == 0)), ("second", r.import_headers)):
        stored_jobs.load_orders(
            store,
            headers,
            r.import_lines,
            job,
            header_rules={"no customer": F.col("customer_id").isNull()},
            detail_rules={"no quantity": F.col("quantity").isNull()},
            header_refs={"unknown customer": ("customer_id", r.table("customer"), "c_custkey")},
            detail_refs={"unknown part": ("part_id", r.table("part"), "p_partkey")},
        )
    return store


@query
def stored_load_headers(r: Roles) -> DataFrame:
    return _loaded_twice(r).read("order_headers")


@query
def stored_load_lines(r: Roles) -> DataFrame:
    return _loaded_twice(r).read("order_lines")


@query
def stored_load_rejects(r: Roles) -> DataFrame:
    return _loaded_twice(r).read("order_rejects")


@query
def stored_load_runs(r: Roles) -> DataFrame:
    return _loaded_twice(r).read("load_runs")


@query
def stored_upsert(r: Roles) -> DataFrame:
    target, source, guard, set_exprs, insert_exprs = _balances_to_merge(r)
    store = new_store(r, balances=(target, "customer_id"))
    stored_jobs.upsert_stored(store, "balances", source, "customer_id", guard, set_exprs, insert_exprs, "merge")
    return store.read("balances")


@query
def order_total(r: Roles) -> DataFrame:
    return loading.order_total(r.order_headers, r.order_lines)


@query
def order_total_skip_null(r: Roles) -> DataFrame:
    return loading.order_total(r.order_headers, r.order_lines, null_as_zero=False)


def _loaded(r: Roles) -> loading.Loaded:
    done = r.table("orders").where(F.col("o_orderdate") < F.lit(dt.date(1995, 2, 1)))
    return loading.load_with_quarantine(
        r.faulty_headers,
        r.faulty_details,
        done.select(F.col("o_orderkey").alias("order_id")),
        header_rules={
            "no customer": F.col("customer_id").isNull(),
            "amount is not a number": F.col("amount_text").try_cast("decimal(14,2)").isNull(),
        },
        detail_rules={},
        header_refs={"unknown customer": ("customer_id", r.table("customer"), "c_custkey")},
        detail_refs={"unknown part": ("part_id", r.table("part"), "p_partkey")},
    )


@query
def load_with_quarantine(r: Roles) -> DataFrame:
    return _loaded(r).rejects


@query
def load_good_headers(r: Roles) -> DataFrame:
    return _loaded(r).headers.select("order_id", "customer_id", "amount_text")


@query
def load_good_details(r: Roles) -> DataFrame:
    return _loaded(r).details


@query
def unload_batch(r: Roles) -> DataFrame:
    batch = r.table("orders").where(F.col("o_orderpriority") == "1-URGENT")
    return loading.unload_batch(
        r.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber"),
        batch.select(F.col("o_orderkey").alias("l_orderkey")),
        "l_orderkey",
    )


@query
def reset_accumulator(r: Roles) -> DataFrame:
    return accumulators.reset_accumulator(
        r.customer_orders, "customer_id", ["order_date", "order_id"], "amount", "1000000"
    )


@query
def reset_accumulator_long(r: Roles) -> DataFrame:
    """Few keys with long histories, laid out so that each crosses range partitions."""
    return accumulators.reset_accumulator(
        r.table("orders"), "o_orderpriority", ["o_orderdate", "o_orderkey"], "o_totalprice",
        "5000000", keep_zero=True, parts=16,
    )


@query
def reset_accumulator_keep_zero(r: Roles) -> DataFrame:
    return accumulators.reset_accumulator(
        accumulators.in_year(r.customer_orders, "order_date", 1998),
        "customer_id", ["order_date", "order_id"], "amount", "1000000", keep_zero=True,
    )


@query
def reset_accumulator_cooldown(r: Roles) -> DataFrame:
    return accumulators.reset_accumulator_cooldown(
        r.customer_orders, "customer_id", "order_date", "amount", "500000"
    )


def _awards(r: Roles) -> DataFrame:
    return accumulators.reset_accumulator(
        accumulators.in_year(r.customer_orders, "order_date", 1998),
        "customer_id", ["order_date", "order_id"], "amount", "1000000",
    )


@query
def award_summary(r: Roles) -> DataFrame:
    return accumulators.award_summary(
        _awards(r), r.customer_orders, r.customer_names, 1998,
        "customer_id", "order_date", "amount", "customer_name",
    )


@query
def award_total(r: Roles) -> DataFrame:
    return accumulators.award_total(_awards(r))


RETYPED = {
    "l_orderkey": "bigint",
    "l_shipdate": "date",
    "l_extendedprice": "decimal(10,2)",
    "l_quantity": "smallint",
}


@query
def retype_table(r: Roles) -> DataFrame:
    lines = r.table("lineitem").select("l_partkey", *RETYPED)
    return loading.retype_table(lines, RETYPED, list(RETYPED))[0]


@query
def stored_retype(r: Roles) -> DataFrame:
    """Columns changed file by file, the job stopped after some of them and started again."""
    store = new_store(r, lines=(r.table("lineitem").select("l_partkey", *RETYPED), "l_orderkey"))
    for files_per_step in (3, None):
        stored_jobs.retype_stored(store, "lines", RETYPED, list(RETYPED), "retype", files_per_step)
    return store.read("lines")


@query
def retype_violations(r: Roles) -> DataFrame:
    lines = r.table("lineitem").select("l_partkey", "l_returnflag", *RETYPED)
    kinds = {**RETYPED, "l_extendedprice": "decimal(6,2)", "l_returnflag": "int"}
    return loading.retype_table(lines, kinds, list(RETYPED))[1]


@query
def check_keys(r: Roles) -> DataFrame:
    return loading.check_keys(
        r.faulty_details.unionByName(r.faulty_details.where(F.col("order_id") % 113 == 0)),
        ["order_id", "line_no"],
        {
            "order_id": (r.order_headers.where(F.col("order_id") % 109 != 0), "order_id"),
            "part_id": (r.table("part"), "p_partkey"),
        },
    )


def _balances_to_merge(r: Roles) -> tuple:
    target = r.table("customer").where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("customer_id"),
        money(F.col("c_acctbal")).alias("balance"),
        F.lit(0).cast("long").alias("n_orders"),
        F.lit("old").alias("state"),
    )
    source = (
        r.customer_orders.groupBy("customer_id")
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    )
    set_exprs = {
        "balance": F.col("t.balance") + F.col("s.amount"),
        "n_orders": F.col("t.n_orders") + F.col("s.n"),
        "state": F.lit("changed"),
    }
    insert_exprs = {
        "customer_id": F.col("s.customer_id"),
        "balance": F.col("s.amount"),
        "n_orders": F.col("s.n"),
        "state": F.lit("new"),
    }
    return target, source, F.col("t.balance") > 0, set_exprs, insert_exprs


@query
def upsert(r: Roles) -> DataFrame:
    target, source, guard, set_exprs, insert_exprs = _balances_to_merge(r)
    return loading.upsert(target, source, "customer_id", guard, set_exprs, insert_exprs)
