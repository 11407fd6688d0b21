"""Choosing documents so that sources come to target weights, with DataFrame functions only.

The sources are the leaves of a tree (domain, language, source). A token budget is handed
down it: every node shares what it has among its children by weight, none gets more than
its leaves can give, and what one cannot take goes to its siblings first. Only what no
child of a node can take is left to the node's own siblings, since a node never asks for
more than its leaves hold. A leaf gives whole epochs and then, in the seeded order of the
next epoch, a prefix of its tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.scratch import Scratch

WORDS = r"[^\x20\x09-\x0D]+"
_BUCKET_DIGITS = 3
_SMALL_PLAN = 100_000  # leaves up to which the plan is sent to all tasks


def n_words(text: Column) -> Column:
    """Words of a text: runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("long")


def _whole(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _on(left: str, right: str, names: Sequence[str]) -> Column:
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return same


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: DataFrame, budget: int, max_epochs: int) -> DataFrame:
    """Add ``allotted`` (tokens) to one row per leaf with ``tokens``.

    ``weights`` has the columns of ``levels`` and ``weight`` (a whole number): a row whose deeper
    levels are null is the weight of an inner node. Nodes without a row weigh 1; a weight of 0, or
    below, shuts a node. Shares are rounded down, so that less than a token a child stays unspent.
    """
    table = leaves.withColumn("_cap_leaf", F.col("tokens") * max_epochs)
    for depth in range(len(levels), 0, -1):
        path, deeper = levels[:depth], levels[depth:]
        own = weights.where(F.col(levels[depth - 1]).isNotNull())
        for name in deeper:
            own = own.where(F.col(name).isNull())
        own = own.groupBy(*path).agg(F.max("weight").cast("long").alias(f"_w{depth}"))
        table = table.alias("t").join(F.broadcast(own).alias("o"), _on("t", "o", path), "left").select(
            "t.*", F.greatest(F.coalesce(F.col(f"_w{depth}"), F.lit(1)), F.lit(0)).alias(f"_w{depth}")
        )
    open_path = F.lit(True)
    for depth in range(1, len(levels) + 1):
        open_path = open_path & (F.col(f"_w{depth}") > 0)
    table = table.withColumn("_cap_leaf", F.when(open_path, F.col("_cap_leaf")).otherwise(0))
    held = table.agg(F.coalesce(F.sum("_cap_leaf"), F.lit(0)).alias("n")).first()["n"]
    given = None
    # the root's window sees one row a domain, each other one the children of a node
    for depth in range(1, len(levels) + 1):
        path, parent = levels[:depth], levels[: depth - 1]
        nodes = table.groupBy(*path).agg(F.sum("_cap_leaf").alias("_cap"), F.max(f"_w{depth}").alias("_w"))
        if parent:
            nodes = nodes.alias("n").join(given.alias("g"), _on("n", "g", parent)).select("n.*", "g._given")
        else:
            nodes = nodes.withColumn("_given", F.lit(min(budget, held)).cast("long"))
        order = Window.partitionBy(*parent).orderBy(F.col("_cap") / F.col("_w"), *path)
        family = Window.partitionBy(*parent)
        before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        behind = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.where((F.col("_w") > 0) & (F.col("_cap") > 0))
        nodes = nodes.withColumn("_before", before).withColumn("_behind", behind)
        full = _whole(F.col("_cap")) * _whole(F.col("_behind")) <= _whole(F.col("_given") - F.col("_before")) * _whole(F.col("_w"))
        nodes = nodes.withColumn("_full", full)
        nodes = nodes.withColumn("_spent", F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(family), F.lit(0)))
        nodes = nodes.withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("_w"))).over(family))
        part = F.expr("cast(_given - _spent AS decimal(20,0)) * cast(_w AS decimal(18,0)) div cast(_open AS decimal(20,0))")
        given = nodes.select(*path, F.when(F.col("_full"), F.col("_cap")).otherwise(part).cast("long").alias("_given"))
    return leaves.alias("l").join(given.alias("g"), _on("l", "g", levels), "left").select(
        "l.*", F.coalesce("_given", F.lit(0)).alias("allotted")
    )


def mix_sources(
    docs: DataFrame,
    levels: Sequence[str],
    weights: DataFrame,
    budget_share: tuple[int, int] = (3, 5),
    max_epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """All rows of ``docs`` with n_tokens, epochs (whole times chosen) and last_tokens.

    ``docs`` has doc_id, text and the columns of ``levels``; null levels are leaves like others.
    The budget is ``budget_share`` (a fraction) of all tokens. last_tokens are those chosen in the
    last epoch, whose order is that of the MD5 of seed, epoch number and doc_id: all tokens of the
    documents before the cut, a prefix of the one at it, none behind. Texts without words (null,
    empty) have no tokens and take nothing. Columns of ``docs`` with the three new names are
    replaced. No rows give no rows.

    Leaves of any size are cut in two steps: sums over 4,096 ranges of the order find the range
    of the cut, and only its rows are ordered.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = docs.drop("n_tokens", "epochs", "last_tokens").withColumn("n_tokens", n_words(F.col("text")))
    leaves = scratch.keep(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    top, bottom = budget_share
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    plan = leaf_budgets(leaves, levels, weights, total * top // bottom, max_epochs)
    some = F.col("tokens") > 0
    plan = plan.select(
        *levels,
        F.when(some, F.expr("allotted div tokens")).otherwise(0).alias("epochs"),
        F.when(some, F.expr("allotted % tokens")).otherwise(0).alias("_rest"),
    )
    plan = scratch.keep(plan, "plan")
    small = plan.count() <= _SMALL_PLAN
    sent = (lambda table: F.broadcast(table)) if small else (lambda table: table)

    key = F.md5(F.concat_ws(":", F.lit(seed), "epochs", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    placed = rows.alias("r").join(sent(plan).alias("p"), _on("r", "p", levels)).select("r.*", "p.epochs", "p._rest")
    placed = placed.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, _BUCKET_DIGITS))
    # at most 4,096 rows a leaf
    sums = placed.groupBy(*levels, "_bucket").agg(F.sum("n_tokens").alias("_sum"), F.max("_rest").alias("_rest"))
    along = Window.partitionBy(*levels).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(along), F.lit(0)))
    # the first range that does not fit whole
    cuts = sums.where(F.col("_before") + F.col("_sum") > F.col("_rest"))
    cuts = cuts.groupBy(*levels).agg(F.min(F.struct("_bucket", "_before")).alias("_cut"))
    cuts = scratch.keep(cuts.select(*levels, F.col("_cut._bucket").alias("_cut"), F.col("_cut._before").alias("_before")), "cuts")
    placed = placed.alias("r").join(sent(cuts).alias("c"), _on("r", "c", levels), "left").select("r.*", "c._cut", "c._before")
    at_cut = F.coalesce(F.col("_bucket") == F.col("_cut"), F.lit(False))
    before = F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut"))
    plain = placed.where(~at_cut).withColumn("last_tokens", F.when(before, F.col("n_tokens")).otherwise(F.lit(0)))
    inside = Window.partitionBy(*levels).orderBy("_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    left = F.greatest(F.col("_rest") - ahead, F.lit(0))
    fine = placed.where(at_cut).withColumn("last_tokens", F.least(F.col("n_tokens"), left))
    return plain.unionByName(fine).drop("_rest", "_key", "_bucket", "_cut", "_before")
