"""What each filter of a chain removes, in every order of the filters.

Four filters look at a text alone; the fifth, E, fails a row whose whole text also stands in a
row of a smaller id. E is an existential self-join: rows whose text's hash occurs more than once
meet the first holder of each such text in a left-semi join on hash, exact text and smaller id.
Its failing rows and those of the other filters are put together, and each row's failures make a
set of bits. All orders are then worked out from the counts of those sets alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.scratch import Scratch

LETTERS = "ABCDE"
_BLANKS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class AuditSettings:
    """Thresholds of the filters, and how crowded hashes are dealt out.

    A hash with more than one of ``crowded`` rows is spread over ``salts`` tasks; there are fewer
    than ``crowded`` such hashes whatever the table, so their list can be sent to all tasks.
    """

    least_words: int = 50
    distinct_percent: int = 65
    capital_percent: int = 5
    marks: str = "#$%&*|"
    crowded: int = 2000
    salts: int = 64


def failures(text: Column, settings: AuditSettings = AuditSettings()) -> Column:
    """Bits of the filters A to D that a text fails (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, _BLANKS), lambda word: word != "")
    facts = F.struct(
        words.alias("words"),
        F.length(text).alias("size"),
        F.length(F.regexp_replace(text, "[A-Z]+", "")).alias("without_capitals"),
    )
    # a list of one, so that the words are cut only once
    return F.get(
        F.transform(
            F.array(facts),
            lambda x: F.when(F.size(x["words"]) < settings.least_words, 1).otherwise(0)
            + F.when(
                100 * F.size(F.array_distinct(x["words"])) < settings.distinct_percent * F.size(x["words"]), 2
            ).otherwise(0)
            + F.when(100 * (x["size"] - x["without_capitals"]) > settings.capital_percent * x["size"], 4).otherwise(0)
            + F.when(text.rlike("[" + "".join("\\" + mark for mark in settings.marks) + "]"), 8).otherwise(0),
        ),
        F.lit(0),
    )


def _hashed(docs: DataFrame) -> DataFrame:
    """Rows with a whole text and two hashes of it."""
    whole = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce("source", F.lit("")).alias("part"),
        whole.alias("whole"),
        F.xxhash64(whole).alias("h1"),
        F.xxhash64(F.lit(1), whole).alias("h2"),
    )


def later_copies(
    docs: DataFrame, hashes: DataFrame, scratch: Scratch, settings: AuditSettings = AuditSettings()
) -> DataFrame:
    """``id``, ``part`` and hashes of the rows whose text also stands in a row of a smaller id.

    ``hashes`` has ``h1`` of every row. Texts are read again but moved only where their hash
    occurs more than once (all of them only where those hashes are too many to be sent out); a
    text that many rows share is reduced to its smallest id before it is moved, and the rows
    asking for it are salted.
    """
    repeated = scratch.keep(hashes.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    # fewer rows than settings.crowded
    hot = F.broadcast(repeated.where(F.col("n") * settings.crowded > hashes.count()).select("h1"))
    rows = _hashed(docs)
    few = rows.join(hot, "h1", "left_anti").join(repeated.select("h1"), "h1", "left_semi")
    many = rows.join(hot, "h1", "left_semi")
    candidates = scratch.keep(
        few.withColumn("salts", F.lit(1)).unionByName(many.withColumn("salts", F.lit(settings.salts))), "candidates"
    )
    first = (
        candidates.groupBy("h1", "h2", "salts", "whole")
        .agg(F.min("id").alias("first_id"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    )
    asking = candidates.withColumn("salt", F.pmod(F.xxhash64("id", "part"), "salts").cast("int")).alias("a")
    held = (
        (F.col("a.h1") == F.col("b.h1"))
        & (F.col("a.h2") == F.col("b.h2"))
        & (F.col("a.salt") == F.col("b.salt"))
        & (F.col("a.whole") == F.col("b.whole"))
        & (F.col("b.first_id") < F.col("a.id"))
    )
    return asking.join(first.alias("b"), held, "left_semi").select("id", "part", "h1", "h2")


def failure_sets(docs: DataFrame, labels: DataFrame, settings: AuditSettings = AuditSettings()) -> DataFrame:
    """``part``, ``bits`` of the failing filters, and how many rows, good rows and toxic rows have them."""
    scratch = Scratch(docs.sparkSession, "audit")
    bits = failures(F.col("whole"), settings).alias("bits")
    own = scratch.keep(_hashed(docs).select("id", "part", "h1", "h2", F.lit(1).alias("rows"), bits), "own")
    copies = later_copies(docs, own, scratch, settings).select("*", F.lit(0).alias("rows"), F.lit(16).alias("bits"))
    # rows alike in id, part and text fail alike, so they may be added up
    marked = own.unionByName(copies).groupBy("id", "part", "h1", "h2").agg(
        F.sum("rows").alias("rows"), F.bit_or("bits").alias("bits")
    )
    # rows without an id come down to one for each part and set of bits before they meet the labels
    sets = marked.groupBy("id", "part", "bits").agg(F.sum("rows").alias("rows"))
    judged = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    joined = sets.join(judged, "id", "left")
    sums = joined.groupBy("part", "bits").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.col("rows") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("rows") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    sums = scratch.keep(sums, "sets")
    scratch.drop_all_but(sums)
    return sums


def _turns(letters: str = LETTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the filters before it, its own bit) of all steps of all orders."""
    rows = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            rows.append(("".join(order), step, before, bit))
            before |= bit
    return rows


def audit_orders(sets: DataFrame) -> DataFrame:
    """Counts of every step of every order, for every part, from the counts of failure sets.

    What a filter removes depends only on which filters came before it, so the 80 pairs of a
    filter and those before it are added up and then dealt out to the 600 steps. Over all orders
    each of a row's failing filters is the first of them equally often.
    """
    turns = _turns()
    pairs: Sequence[tuple[int, int]] = sorted({(before, bit) for _, _, before, bit in turns})
    spread = sets.withColumn("pair", F.explode(F.array(*[F.struct(F.lit(b).alias("before"), F.lit(o).alias("own")) for b, o in pairs])))
    fails = F.col("bits").bitwiseAND(F.col("own")) != 0
    passed = F.col("bits").bitwiseAND(F.col("before")) == 0

    def total(condition: Column, counted: str = "rows") -> Column:
        return F.sum(F.when(condition, F.col(counted)).otherwise(0)).cast("long")

    orders = 120 / F.bit_count("bits")  # whole: one to five filters fail
    facts = spread.select("part", "bits", "rows", "good", "toxic", "pair.*").groupBy("part", "before", "own").agg(
        total(~fails & passed).alias("kept"),
        total(fails & passed).alias("removed"),
        total(fails & ~passed).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"),
        total(fails & passed, "good").alias("good_lost"),
        total(fails & passed, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("rows") * orders.cast("long")).otherwise(0)).cast("long").alias("shapley"),
    )
    steps = sets.sparkSession.createDataFrame(turns, "filter_order string, step int, before int, own int")
    # always 600 rows
    return facts.join(F.broadcast(steps), ["before", "own"]).drop("before", "own")


def audit_filters(docs: DataFrame, labels: DataFrame, settings: AuditSettings = AuditSettings()) -> DataFrame:
    """One row for every part, order of the filters and step.

    A null text is empty, a null source the part ``''``. Rows that repeat an id are all counted;
    equal texts of equal ids do not fail each other, and a row without an id neither fails E nor
    makes another fail it. A document is good or toxic if any of its label rows says so. An empty
    table gives no rows; other columns play no part.
    """
    return audit_orders(failure_sets(docs, labels, settings))
