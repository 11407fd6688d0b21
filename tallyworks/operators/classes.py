"""Risk classes, their publication and checks on it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.dates import long_date
from tallyworks.functions.values import ladder, pack, ratio, rounded, unpack
from tallyworks.operators.numbering import number_rows

# fixed values: worst delay, highest debt-to-income share, class, score
CLASS_LADDER = (
    (7, 0.5, 1, 2648),
    (30, 0.6, 2, 1986),
    (60, 0.7, 3, 1324),
    (90, 0.8, 4, 662),
)
WORST_CLASS = (5, 0)

# fixed values: income below, then (share below, class) in order, then the class otherwise
INCOME_BANDS = (
    (2500, (), 4),
    (3000, ((0.4, 3),), 4),
    (3500, ((0.3, 2), (0.5, 3)), 4),
    (5000, ((0.5, 2), (0.6, 3)), 4),
    (10000, ((0.6, 2), (0.7, 3)), 4),
    (18000, ((0.7, 2), (0.8, 3)), 4),
)
TOP_BAND = (18000, ((0.8, 2),), 3)
NO_BAND_CLASS = 4


def client_profile(exposure: DataFrame, income: DataFrame, payments: DataFrame) -> DataFrame:
    """Exposure with average income and monthly payment where known."""
    return exposure.join(income, "tax_id", "left").join(payments, "tax_id", "left").select(
        "client_id", "tax_id", "debt", "dpd", F.col("avg_salary").alias("income"), "payment"
    )


def risk_class(
    profile: DataFrame,
    steps: Sequence[tuple[int, float, int, int]] = CLASS_LADDER,
    worst: tuple[int, int] = WORST_CLASS,
) -> DataFrame:
    """Class and score from worst delay and debt-to-income; no income is the worst class."""
    known = profile.select(
        "client_id",
        "tax_id",
        ratio(F.col("payment"), F.col("income")).alias("dti"),
        F.coalesce("income", F.lit(0.0)).alias("income"),
        "payment",
        F.coalesce("dpd", F.lit(0)).alias("dpd"),
        "debt",
    )

    def graded(position: int) -> Column:
        rungs = [(F.col("income") == 0, F.lit(worst[position - 2]))]
        for rung in steps:
            fits = (F.col("dpd") <= rung[0]) & (F.col("dti") < rung[1])
            rungs.append((fits, F.lit(rung[position])))
        return ladder(rungs, F.lit(worst[position - 2]))

    return known.withColumns({"class": graded(2), "score": graded(3)}).distinct()


def publish_report(classes: DataFrame, as_of: dt.date) -> DataFrame:
    """Dated rows with the figures packed into text, ready to append."""

    def amount(name: str) -> Column:
        return rounded(F.col(name)).cast("decimal(18,2)").cast("string")

    # fixed values: the names in the packed texts
    return classes.select(
        long_date(F.lit(as_of)).alias("report_date"),
        "client_id",
        "tax_id",
        "class",
        pack(
            [
                ("Income", amount("income")),
                ("Payment", F.coalesce(amount("payment"), F.lit("0.00"))),
                ("DTI", amount("dti")),
                ("DPD", F.col("dpd").cast("string")),
                ("Sum_dolg", amount("debt")),
            ]
        ).alias("parameters"),
        pack([("DTI_DPD", F.col("score").cast("string"))]).alias("score"),
    )


def parse_parameters(df: DataFrame, col: str, key: str, name: str = "value") -> DataFrame:
    """Add one number read back from a packed text column."""
    return df.withColumn(name, unpack(F.col(col), key))


def exported_columns(published: DataFrame) -> DataFrame:
    """The columns of one publication that are exported, and the tax id to order them by."""
    return published.select(
        "client_id",
        "class",
        F.lit("").alias("note"),
        "report_date",
        F.lit("1").alias("calc_type"),
        "tax_id",
    )


def numbered_publication(published: DataFrame) -> DataFrame:
    """One publication, numbered from the highest client id."""
    rows = exported_columns(published)
    return number_rows(rows, [F.col("client_id").desc(), "tax_id"], "rn").drop("tax_id")


def latest_publication(report: DataFrame) -> DataFrame:
    """Newest publication of a frame with all of them, numbered.

    Reads every publication for its date; where they are stored by day, ``read_publication``
    finds the newest without that.
    """
    day = F.to_date("report_date", "dd MMM yyyy")
    return numbered_publication(report.where(day == report.agg(F.max(day)).scalar()))


def high_income_class(df: DataFrame) -> DataFrame:
    """Class by income band for large amounts. Income of exactly the top bound, or none, gives 4."""
    scored = df.where(F.col("amount_type") == "High").withColumn(
        "dti", ratio(F.col("payment"), F.col("income"))
    )

    def within(shares: Sequence[tuple[float, int]], otherwise: int) -> Column:
        return ladder([(F.col("dti") < top, F.lit(c)) for top, c in shares], F.lit(otherwise))

    rungs = [
        (F.col("income") < bound, within(shares, otherwise))
        for bound, shares, otherwise in INCOME_BANDS
    ]
    rungs.append((F.col("income") > TOP_BAND[0], within(*TOP_BAND[1:])))
    return scored.select(
        "client_id",
        "tax_id",
        "deal_id",
        "income",
        "dti",
        ladder(rungs, F.lit(NO_BAND_CLASS)).alias("class"),
        *[F.lit("0").alias(name) for name in ("from_date", "input_date", "class_2", "class_3")],
        F.lit("1").alias("not_is_group"),
    )


def latest_iteration_per_key(
    df: DataFrame, exclude: Sequence[str] = ("0000000000", "9999999999")
) -> DataFrame:
    """Payment from each tax id's last scored iteration."""
    newest = (
        df.where((F.col("order_no") > 0) & F.col("dti").isNotNull())
        .groupBy("tax_id")
        .agg(F.max("iteration_id").alias("iteration_id"))
        .select("iteration_id")
    )
    return (
        df.where(~F.col("tax_id").isin(*exclude))
        .join(newest, "iteration_id", "left_semi")
        .select(
            "tax_id",
            F.round(F.col("income") * F.col("dti"), 2).cast("decimal(20,2)").alias("payment"),
        )
    )


def report_qc(report: DataFrame, exported: DataFrame, dense: int = 2) -> DataFrame:
    """Check figures of a publication as (check, item, n) rows."""
    by_class = report.groupBy("report_date", "class").count().select(
        F.lit("rows_by_class").alias("check"),
        F.concat_ws(" ", F.col("report_date"), F.col("class").cast("string")).alias("item"),
        F.col("count").cast("double").alias("n"),
    )
    repeated = repeated_keys(report, ["client_id"], dense).select(
        F.lit("repeated_client").alias("check"),
        F.col("client_id").cast("string").alias("item"),
        F.col("n").cast("double").alias("n"),
    )
    good = (
        report.where(F.col("class") != WORST_CLASS[0]).select("client_id").distinct()
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
        .select(F.lit("clients_not_worst").alias("check"), F.lit("all").alias("item"), "n")
    )
    total = report.agg(F.count(F.lit(1))).scalar()
    progress = exported.agg(
        (F.count(F.lit(1)).cast("double") * 100 / total.cast("double")).alias("n")
    ).select(F.lit("exported_percent").alias("check"), F.lit("all").alias("item"), "n")
    return by_class.unionByName(repeated).unionByName(good).unionByName(progress)


def repeated_keys(df: DataFrame, keys: Sequence[str], more_than: int) -> DataFrame:
    """Keys with more than ``more_than`` rows."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)
    )


def report_top(df: DataFrame, where: Column, by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` of the chosen rows, for looking at."""
    return df.where(where).orderBy(*by).limit(n)
