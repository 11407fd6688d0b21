"""Loading, correcting and checking tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.sources.storage import freeze


def order_total(
    headers: DataFrame, details: DataFrame, key: str = "order_id", null_as_zero: bool = True
) -> DataFrame:
    """Order amount after discount plus freight; orders without lines drop out.

    A line with no amount counts as zero or is skipped: an order with only such
    lines then has its freight, or no total at all.
    """
    line = F.col("quantity") * F.col("unit_price")
    if null_as_zero:
        line = F.coalesce(line, F.lit(0))
    sums = details.groupBy(key).agg(F.sum(line).alias("_amount"))
    total = F.col("_amount") * (1 - F.col("discount")) + F.col("freight")
    return headers.join(sums, key).withColumn("total", total.cast("decimal(20,4)")).drop("_amount")


class Loaded(NamedTuple):
    headers: DataFrame
    details: DataFrame
    rejects: DataFrame


def load_with_quarantine(
    headers: DataFrame,
    details: DataFrame,
    target_keys: DataFrame,
    header_rules: Mapping[str, Column],
    detail_rules: Mapping[str, Column],
    header_refs: Mapping[str, tuple[str, DataFrame, str]],
    detail_refs: Mapping[str, tuple[str, DataFrame, str]],
    key: str = "order_id",
) -> Loaded:
    """Split an import into whole good orders and rejected ones with their errors.

    Rules are conditions that are true for bad rows. Refs are (column, table,
    table column) of values that must exist. A key that occurs twice, or is
    already loaded, is an error too, and so is a missing key. One bad line rejects
    its order. An order without lines is in none of the results, as there is nothing to load.

    What is found about each order of the import is stored once, for all three results.
    """

    def broken(df: DataFrame, rules: Mapping[str, Column]) -> list[DataFrame]:
        if not rules:
            return []
        found = F.array_compact(F.array(*[F.when(c, F.lit(m)) for m, c in rules.items()]))
        return [df.select(key, F.explode(found).alias("error"))]

    def dangling(df: DataFrame, refs: Mapping[str, tuple[str, DataFrame, str]]):
        for message, (column, table, table_column) in refs.items():
            known = table.select(F.col(table_column).alias(column))
            yield (
                df.where(F.col(column).isNotNull())
                .select(key, column)
                .join(known, column, "left_anti")
                .select(key, F.lit(message).alias("error"))
            )

    # lines and loaded orders without a key belong to no order; those of other orders go with their groups
    keyed = details.where(F.col(key).isNotNull())
    errors = [
        target_keys.where(F.col(key).isNotNull()).select(key, F.lit("already loaded").alias("error")),
        *broken(headers, {**header_rules, "no order key": F.col(key).isNull()}),
        *broken(keyed, detail_rules),
        *dangling(headers, header_refs),
        *dangling(keyed, detail_refs),
    ]
    once = headers.select(key, F.lit(None).cast("string").alias("error"), F.lit(1).alias("_header"))
    found = [df.select(key, "error", F.lit(0).alias("_header")) for df in errors]
    repeated = F.when(F.sum("_header") > 1, F.array(F.lit("duplicate order"))).otherwise(F.array().cast("array<string>"))
    # the set of messages per order is bounded by the number of rules
    messages = F.sort_array(F.concat(F.collect_set("error"), repeated))
    orders = (
        reduce(DataFrame.unionByName, [once, *found])
        .groupBy(key)
        .agg(
            F.sum("_header").alias("_headers"),
            F.when(F.size(messages) > 0, F.array_join(messages, "; ")).alias("errors"),
        )
        .where("_headers > 0")
        .drop("_headers")
    )
    orders = freeze(orders, "import-orders")
    good_details = details.join(orders.where("errors IS NULL").select(key), key, "left_semi")
    # lines are left of good orders only
    good_headers = headers.join(good_details.select(key), key, "left_semi")
    return Loaded(good_headers, good_details, orders.where("errors IS NOT NULL"))


def unload_batch(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``target`` without the rows whose key is in ``batch``."""
    return target.join(batch.select(key), key, "left_anti")


def retype_table(
    df: DataFrame, types: Mapping[str, str], not_null: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The table in new column types, and how many values stand in the way.

    Reading the first result fails on a value its type cannot hold, as a change
    of the stored table would; the second one counts such values beforehand.
    """
    casts = {c: F.col(c).cast(types[c]) if c in types else F.col(c) for c in df.columns}
    retyped = df.select(*[value.alias(c) for c, value in casts.items()])
    checks = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{c}: does not fit")
        for c, t in types.items()
    ] + [F.count_if(F.col(c).isNull()).alias(f"{c}: is null") for c in not_null]
    counts = df.agg(*checks).withColumn("_all", F.lit(1))
    violations = counts.unpivot("_all", None, "problem", "n").drop("_all")
    return retyped, violations


def check_keys(
    df: DataFrame, pk: Sequence[str], fks: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Repeated primary keys and unmatched foreign keys as (check, key, n) rows."""
    shown = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in pk])
    rows = [
        df.groupBy(*pk)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.lit("primary key").alias("check"), shown.alias("key"), "n")
    ]
    for column, (table, table_column) in fks.items():
        used = df.where(F.col(column).isNotNull()).groupBy(column).agg(
            F.count(F.lit(1)).alias("n")
        )
        missing = used.join(
            table.select(F.col(table_column).alias(column)), column, "left_anti"
        )
        rows.append(
            missing.select(
                F.lit(f"foreign key {column}").alias("check"),
                F.col(column).cast("string").alias("key"),
                "n",
            )
        )
    return reduce(DataFrame.unionByName, rows)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    guard: Column,
    set_exprs: Mapping[str, Column],
    insert_exprs: Mapping[str, Column],
) -> DataFrame:
    """``target`` after a merge: unmatched source rows added, matched rows changed.

    Expressions name columns as ``t.x`` and ``s.x``. A matched row changes only
    where ``guard`` holds. A key that ``source`` repeats stops the merge with an error; source
    rows without a key match nothing and are added.
    """
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    # the window needs the keys where the join needs them too
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    twice = F.raise_error(F.concat(F.lit("repeated source key "), F.col(key).cast("string"))).cast("boolean")
    once = F.when(F.col(key).isNotNull() & (n > 1), twice).otherwise(F.lit(True))
    s = source.withColumn("_in_s", once).alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    new = F.col("t._in_t").isNull()
    changed = F.col("s._in_s").isNotNull() & guard
    columns = []
    for name in target.columns:
        old = F.col(f"t.{name}")
        kind = target.schema[name].dataType.simpleString()
        inserted = insert_exprs.get(name, F.lit(None)).cast(kind)
        updated = set_exprs.get(name, old).cast(kind)
        columns.append(F.when(new, inserted).when(changed, updated).otherwise(old).alias(name))
    return joined.select(*columns)
