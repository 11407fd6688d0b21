"""Running sums that start over when they reach a limit.

Where the next restart lies depends on the one before, so a key's rows are
taken in order. The rows are sorted over range partitions by key and order,
and each partition is folded as it is read, without another shuffle. A key
that lies inside one partition is done then. A partition's first and last key
may go on in its neighbours: for these it stores what the sum and the highest
sum of their rows are, and, for every row that could be the first restart, how
open a sum it takes to restart there and what follows from there on. So the
state after a partition is known from the state before it without its rows,
and a key over any number of partitions is put together from few figures each.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tallyworks.operators.numbering import with_starts
from tallyworks.sources.shipping import ship
from tallyworks.sources.storage import freeze

MONEY = "decimal(14,2)"
#: Kinds of rows that a partition stores.
WHOLE, EDGE, TURN = 0, 1, 2
_FIGURES = ("segment", "presents", "open_sum", "total", "high", "need")


def reset_accumulator(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    amount: str,
    limit: str,
    cap: int = 10,
    keep_zero: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """How often a key's sum reaches ``limit``, starting over at zero each time.

    What goes beyond the limit is lost. At most ``cap`` are counted. Keys that
    never reach the limit are returned only with ``keep_zero``. A null amount adds
    nothing, rows with equal ``order`` follow each other by amount, and a null key
    is a key like others. ``parts`` sets the number of range partitions (Spark's
    choice without it); the result does not depend on it.
    """
    ship(df.sparkSession)
    goal = int(Decimal(limit).quantize(Decimal("0.01"), ROUND_HALF_UP) * 100)
    cents = F.coalesce((F.col(amount).cast(MONEY) * 100).cast("long"), F.lit(0).cast("long"))
    rows = df.select(F.col(key).alias("_key"), *[F.col(name).alias(f"_o{i}") for i, name in enumerate(order)], cents.alias("_cents"))
    by = ["_key", *[f"_o{i}" for i in range(len(order))], "_cents"]
    laid = rows.repartitionByRange(*([parts] if parts else []), *by).sortWithinPartitions(*by).select("_key", "_cents")
    figures = [StructField(name, LongType()) for name in _FIGURES]
    schema = StructType([laid.schema["_key"], StructField("kind", IntegerType()), *figures])
    folded = freeze(laid.mapInArrow(_folded(laid.schema, schema, goal, cap), schema), "folded")
    counted = folded.where(F.col("kind") == WHOLE).select("_key", "presents")
    counted = counted.unionByName(_joined_edges(folded, goal, cap))
    counted = counted if keep_zero else counted.where(F.col("presents") > 0)
    return counted.select(F.col("_key").alias(key), F.col("presents").cast("int").alias("presents"))


def _next_reached(sums: np.ndarray, goal: int) -> np.ndarray:
    """For each place of running sums the next one that is higher by ``goal``, or one past the end."""
    n = len(sums)
    if (np.diff(sums) >= 0).all():
        return np.maximum(np.searchsorted(sums, sums + goal), np.arange(n) + 1)
    # sums go down too: from the end, keep the places that are higher than all between
    reached, places, heights = np.full(n, n), [], []
    for place in range(n - 1, -1, -1):
        at = bisect_right(heights, -(int(sums[place]) + goal)) - 1
        if at >= 0:
            reached[place] = places[at]
        while heights and heights[-1] >= -int(sums[place]):
            places.pop(), heights.pop()
        places.append(place), heights.append(-int(sums[place]))
    return reached


def _restarts(reached: np.ndarray, starts: np.ndarray, ends: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Restarts from each start up to its end, ``cap`` at most, and the place of the last one."""
    count, at = np.zeros(len(starts), np.int64), starts.copy()
    for _ in range(cap):
        to = reached[at]
        hit = to <= ends
        if not hit.any():
            break
        count += hit
        at = np.where(hit, to, at)
    return count, at


def _running(cents: np.ndarray) -> np.ndarray:
    """Running sums with a zero in front."""
    if len(cents) and int(np.abs(cents).max()) * len(cents) >= 2**62:
        raise OverflowError("the sum of a key's amounts in one partition might not fit in 64 bits")
    return np.concatenate([[0], np.cumsum(cents)])


def _edge(cents: np.ndarray, segment: int, goal: int, cap: int) -> dict[str, np.ndarray]:
    """Figures of an edge key's rows in a partition: one summary, and a row for each possible first restart."""
    sums = _running(cents)
    reached, n = _next_reached(sums, goal), len(cents)
    highest = np.maximum.accumulate(sums[1:])
    # a first restart is higher than all rows before it
    turns = 1 + np.flatnonzero(np.concatenate([[True], highest[1:] > highest[:-1]]))
    places = np.concatenate([[0], turns])
    count, last = _restarts(reached, places, np.full(len(places), n), cap)
    count[1:] += 1
    return {
        "kind": np.where(np.arange(len(places)) == 0, EDGE, TURN),
        "segment": np.full(len(places), segment),
        "presents": count,
        "open_sum": sums[n] - sums[last],
        "total": np.full(len(places), sums[n]),
        "high": np.full(len(places), highest[-1]),
        "need": goal - sums[places],
    }


def _folded(laid: StructType, schema: StructType, goal: int, cap: int):
    """Task function: counts of the keys inside a partition, figures of its first and last key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        key, held, edges = None, [], 0  # the open key, its rows so far

        def table(keys: pa.Array, figures: dict[str, np.ndarray]) -> pa.RecordBatch:
            nothing = pa.nulls(len(keys), pa.int64())
            columns = [pa.array(figures["kind"], pa.int32())]
            columns += [pa.array(figures[name], pa.int64()) if name in figures else nothing for name in _FIGURES]
            return pa.RecordBatch.from_arrays([keys, *columns], schema.fieldNames())

        def edge() -> pa.RecordBatch:
            figures = _edge(np.concatenate(held), 2 * part + edges, goal, cap)
            return table(key.take(pa.array(np.zeros(len(figures["kind"]), np.int64))), figures)

        def whole(keys: pa.Array, cents: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
            sums, ends = _running(cents), np.append(starts[1:], len(cents))
            count, _ = _restarts(_next_reached(sums, goal), starts, ends, cap)
            return table(keys, {"kind": np.full(len(starts), WHOLE), "presents": count})

        for batch, marks in with_starts(batches, laid, ["_key"]):
            starts = np.flatnonzero(marks)
            keys, cents = batch.column("_key"), batch.column("_cents").to_numpy()
            if not len(starts):
                held.append(cents)
                continue
            if held:
                held.append(cents[: starts[0]])
                if not edges:
                    yield edge()
                    edges = 1
                else:
                    yield whole(key, np.concatenate(held), np.zeros(1, np.int64))
            inside = starts[:-1]
            if not edges and len(inside):  # the partition's first key begins and ends in this batch
                key, held = keys.slice(0, 1), [cents[: starts[1]]]
                yield edge()
                edges, inside = 1, inside[1:]
            if len(inside):
                yield whole(keys.take(pa.array(inside)), cents[inside[0] : starts[-1]], inside - inside[0])
            key, held = keys.slice(int(starts[-1]), 1), [cents[starts[-1] :]]
        if held:
            yield edge()

    return run


@dataclass
class _Chain:
    """A key's segments in order and how far it has been followed: its count and open sum there."""

    segments: list
    at: int = 0
    presents: int = 0
    open_sum: int = 0

    def follow(self, goal: int, cap: int) -> bool:
        """Pass over the segments that the open sum cannot make restart; whether one is left that it may."""
        while self.at < len(self.segments) and self.presents < cap:
            segment = self.segments[self.at]
            if self.at == 0:
                self.presents, self.open_sum = segment["presents"], segment["open_sum"]
            elif self.open_sum + segment["high"] < goal:
                self.open_sum += segment["total"]
            else:
                return True
            self.at += 1
        return False


def _numbers(spark: SparkSession, first: str, second: str, rows: list[tuple[int, int]]) -> DataFrame:
    table = pa.table([pa.array([row[i] for row in rows], pa.int64()) for i in (0, 1)], names=[first, second])
    return spark.createDataFrame(table)


def _joined_edges(folded: DataFrame, goal: int, cap: int) -> DataFrame:
    """``_key`` and ``presents`` of the keys at the edges of partitions.

    There are at most two edges to a partition, so their summaries are few whatever the data.
    All keys are followed at once; a round looks up the segments in which they restart next, and
    a segment gives all of a key's restarts in it, so there are ``cap`` rounds at most.
    """
    spark = folded.sparkSession
    edges = folded.where(F.col("kind") == EDGE)
    goes_on = F.col("_key").eqNullSafe(F.lag("_key").over(Window.orderBy("segment")))
    listed = edges.select("segment", "presents", "open_sum", "total", "high", goes_on.alias("goes_on")).collect()
    chains: list[_Chain] = []
    for row in sorted(listed, key=lambda row: row["segment"]):
        if row["goes_on"] and chains:
            chains[-1].segments.append(row)
        else:
            chains.append(_Chain([row]))
    while waiting := [chain for chain in chains if chain.follow(goal, cap)]:
        by_segment = {chain.segments[chain.at]["segment"]: chain for chain in waiting}
        asked = _numbers(spark, "segment", "entering", [(at, chain.open_sum) for at, chain in by_segment.items()])
        # no more rows than edges
        turns = folded.where((F.col("kind") == TURN) & F.col("segment").isin(list(by_segment))).join(
            F.broadcast(asked), "segment"
        )
        # the first of the turns that the open sum is enough for needs the most
        met = turns.where("need <= entering").groupBy("segment").agg(
            F.max_by(F.struct("presents", "open_sum"), "need").alias("end")
        )
        for row in met.collect():
            chain = by_segment[row["segment"]]
            chain.presents = min(chain.presents + row["end"]["presents"], cap)
            chain.open_sum = row["end"]["open_sum"]
            chain.at += 1
    ends = _numbers(spark, "segment", "presents", [(chain.segments[0]["segment"], chain.presents) for chain in chains])
    return edges.select("_key", "segment").join(F.broadcast(ends), "segment").select("_key", "presents")


def reset_accumulator_cooldown(
    df: DataFrame,
    key: str,
    date: str,
    amount: str,
    limit: str,
    cap: int = 10,
    wait_days: int = 10,
) -> DataFrame:
    """The same on daily sums, with days of rest after each restart.

    Days up to ``wait_days`` after a restart are passed over and their sums lost.
    Adding up per day first bounds a key's history by the days of the calendar,
    so one row can hold it whatever the key's share of the data.
    """
    goal = F.lit(limit).cast(MONEY)
    zero = F.lit("0").cast(MONEY)
    daily = df.groupBy(key, F.to_date(date).alias("_day")).agg(
        F.sum(F.col(amount).cast(MONEY)).cast(MONEY).alias("_amount")
    )

    def step(state, entry):
        total = (state["sum"] + entry["_amount"]).cast(MONEY)
        reached = total >= goal
        resting = (state["n"] >= cap) | (F.datediff(entry["_day"], state["latest"]) <= wait_days)
        return F.when(resting, state).otherwise(
            F.struct(
                F.when(reached, zero).otherwise(total).alias("sum"),
                F.when(reached, state["n"] + 1).otherwise(state["n"]).alias("n"),
                F.when(reached, entry["_day"]).otherwise(state["latest"]).alias("latest"),
            )
        )

    start = F.struct(
        zero.alias("sum"), F.lit(0).alias("n"), F.to_date(F.lit("1900-01-01")).alias("latest")
    )
    folded = (
        daily.groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("_day", "_amount"))).alias("_history"))
        .select(key, F.aggregate("_history", start, step).alias("_end"))
    )
    return folded.select(
        key,
        F.col("_end.n").alias("presents"),
        F.col("_end.sum").alias("open_sum"),
        F.col("_end.latest").alias("latest_present"),
    )


def in_year(df: DataFrame, date: str, year: int) -> DataFrame:
    """Rows dated 1 January to 31 December, as a range the scan can use."""
    first, after = F.lit(f"{year:04d}-01-01"), F.lit(f"{year + 1:04d}-01-01")
    day = F.col(date)
    return df.where((day >= first.cast("date")) & (day < after.cast("date")))


def award_total(awards: DataFrame) -> DataFrame:
    return awards.agg(F.coalesce(F.sum("presents"), F.lit(0)).alias("total_presents"))


def award_summary(
    awards: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    year: int,
    key: str,
    date: str,
    amount: str,
    customer_name: str,
) -> DataFrame:
    """Presents next to each customer's orders of the year, largest customers first."""
    value = F.col(amount).cast(MONEY)
    figures = (
        in_year(orders, date, year)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(value).cast("decimal(20,2)").alias("total_amount"),
        )
        .withColumn("avg_amount", F.col("total_amount").cast("double") / F.col("n_orders"))
    )
    return (
        awards.join(figures, key)
        .join(customers.select(key, customer_name), key)
        .orderBy(F.col("total_amount").desc(), key)
    )
