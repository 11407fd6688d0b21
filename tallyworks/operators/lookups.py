"""Everyday selections: lookups, slices, sorts and text filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import contains_literal, matches_none, text_length


def star_denormalize(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str, Mapping[str, str]]]
) -> DataFrame:
    """Left-join lookups to a fact.

    Each lookup is (table, fact key, lookup key, {lookup column: new name}). How
    it is joined is left to Spark, which broadcasts only below its size limit.
    """
    joined = fact
    for table, fact_key, dim_key, renamed in dims:
        narrow = table.select(
            F.col(dim_key).alias(fact_key),
            *[F.col(column).alias(alias) for column, alias in renamed.items()],
        )
        joined = joined.join(narrow, fact_key, "left")
    return joined


def day_slice(df: DataFrame, col: str, value, date_col: str, lo, hi) -> DataFrame:
    """All columns of the rows with ``value`` and a date in [lo, hi)."""
    return df.where(
        (F.col(col) == value) & (F.col(date_col) >= F.lit(lo)) & (F.col(date_col) < F.lit(hi))
    )


def point_lookup(
    df: DataFrame, col: str, value, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows with one value; naming columns lets the scan read only those."""
    found = df.where(F.col(col) == value)
    return found.select(*columns) if columns else found


def top_rows(df: DataFrame, columns: Sequence[str], n: int, order_by: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(n).select(*columns)


def scan_all(df: DataFrame) -> DataFrame:
    return df


def case_sort(df: DataFrame, amount: str, threshold, then: str) -> DataFrame:
    """Rows below the threshold first (nulls with them), each part by name."""
    high = F.when(F.col(amount) >= threshold, 1).otherwise(0)
    return df.orderBy(high, then)


def nested_case(
    df: DataFrame, steps: Sequence[tuple[Column, str | tuple[str, Mapping]]], default: str, name: str
) -> DataFrame:
    """Add ``name``: what the first step whose condition holds says, else ``default``.

    A step gives a label, or a column with a mapping of its values to labels; a value that the
    mapping leaves out gives null and not ``default``.
    """
    chain = None
    for condition, said in steps:
        if isinstance(said, str):
            value = F.lit(said)
        else:
            column, labels = said
            value = F.lit(None).cast("string")
            for key, label in labels.items():
                value = F.when(F.col(column) == key, label).otherwise(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return df.withColumn(name, F.lit(default) if chain is None else chain.otherwise(default))


def like_literal(df: DataFrame, col: str, text: str) -> DataFrame:
    """Rows whose text contains ``text``, ``%`` and ``_`` standing for themselves."""
    return df.where(contains_literal(F.col(col), text))


def undefined_products(
    df: DataFrame,
    product: str,
    date: str,
    exclude_patterns: Sequence[str],
    status: Column,
) -> DataFrame:
    """Count and first and last date of the products no pattern explains.

    The dates are text with three leading blanks and are sorted as such, newest
    day of the month first.
    """

    def shown(value: Column) -> Column:
        return F.concat(F.lit("   "), F.date_format(value, "dd-MM-yyyy"))

    return (
        df.where(status & matches_none(F.col(product), exclude_patterns))
        .groupBy(F.col(product).alias("product"))
        .agg(
            F.count(F.lit(1)).alias("qty"),
            shown(F.min(date)).alias("min_date"),
            shown(F.max(date)).alias("max_date"),
        )
        .orderBy(F.col("max_date").desc(), "product")
    )


def max_text_length(df: DataFrame, col: str) -> DataFrame:
    """Longest value, trailing blanks not counted."""
    return df.agg(F.max(text_length(F.col(col))).alias("max_length"))


def definition_search(
    texts: DataFrame, objects: DataFrame, key: str, text: str, pattern: str, shown: Sequence[str]
) -> DataFrame:
    """Objects whose definition text matches a LIKE pattern, each once.

    Only keys of matching texts are shuffled, not the texts.
    """
    matching = texts.where(F.col(text).like(pattern)).select(key)
    return objects.join(matching, key).select(*shown).distinct()
