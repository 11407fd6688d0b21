"""Delimited lists: building, splitting, and projections made from a list of names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def listagg_by_group(
    df: DataFrame, key: str, value: str, sep: str = ",", name: str = "items"
) -> DataFrame:
    """Sorted list of a key's values; duplicates stay, nulls drop out.

    Equal values are counted before the shuffle and written out again by
    ``repeat``, so a key moves its distinct values and not its rows.
    """
    counted = df.groupBy(key, value).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    runs = counted.withColumn(
        "_entry", F.concat(F.col(value).cast("string"), F.lit(sep))
    ).select(key, F.col(value).alias("_v"), F.expr("repeat(_entry, _n)").alias("_run"))
    joined = F.expr("listagg(_run, '') WITHIN GROUP (ORDER BY _v)")
    return runs.groupBy(key).agg(joined.alias("_all")).select(
        key, F.expr(f"left(_all, length(_all) - {len(sep)})").alias(name)
    )


def listagg_top_n(
    df: DataFrame, value: str, n: int, order_by: Sequence[str], sep: str = ",", name: str = "items"
) -> DataFrame:
    """List of the first ``n`` rows' values in the given order."""
    first = df.orderBy(*order_by).limit(n).select(
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
        F.concat(F.lit(sep), F.col(value).cast("string")).alias("_entry"),
    )
    order = ", ".join(f"_o{i}" for i in range(len(order_by)))
    return first.agg(
        F.expr(f"listagg(_entry, '') WITHIN GROUP (ORDER BY {order})").alias("_all")
    ).select(F.expr(f"substring(_all, {len(sep) + 1})").alias(name))


def distinct_pairs(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.select(first, second).distinct()


def split_trim(df: DataFrame, col: str, sep: str = ",", name: str = "item") -> DataFrame:
    """One row per list entry, blanks around it removed; ``sep`` is taken literally."""
    entries = F.split(F.col(col), F.lit("\\Q" + sep + "\\E"))
    return df.withColumn(name, F.explode(entries)).withColumn(name, F.trim(name))


def names_from_list(text: str, sep: str = ",") -> list[str]:
    """Column names out of ``[A],[B],[C]``."""
    return [entry.strip().removeprefix("[").removesuffix("]") for entry in text.split(sep)]


def sum_columns_from_list(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sum of every named column, each under its own name."""
    return df.agg(*[F.sum(name).alias(name) for name in names])
