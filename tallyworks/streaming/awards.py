"""Running sums that start over at a limit, kept per key over a stream of orders."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyworks.sources.shipping import ship


def stream_reset_accumulator(
    orders: DataFrame,
    key: str,
    order: Sequence[str],
    amount: str,
    limit: str,
    cap: int = 10,
) -> DataFrame:
    """Stream of (key, presents, open_sum) after each micro-batch a key appears in.

    Rows of one micro-batch are taken in ``order``; later micro-batches must hold
    later rows. What a task holds for a key is its share of one micro-batch, so
    the source's rate limit (such as ``maxFilesPerTrigger``) bounds it.
    """
    ship(orders.sparkSession)
    key_type = orders.schema[key].dataType.simpleString()
    goal = Decimal(limit)

    def advance(
        group: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        total, presents = state.get if state.exists else (Decimal(0), 0)
        rows = pd.concat(list(batches)).sort_values(list(order))
        for value in rows[amount]:
            if presents >= cap:
                break
            total += value
            if total >= goal:
                total, presents = Decimal(0), presents + 1
        state.update((total, presents))
        yield pd.DataFrame({key: [group[0]], "presents": [presents], "open_sum": [total]})

    return (
        orders.select(key, *order, orders[amount].cast("decimal(14,2)").alias(amount))
        .groupBy(key)
        .applyInPandasWithState(
            advance,
            f"{key} {key_type}, presents int, open_sum decimal(14,2)",
            "total decimal(14,2), presents int",
            "update",
            GroupStateTimeout.NoTimeout,
        )
    )
