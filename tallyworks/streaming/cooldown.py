"""Running sums with days of rest, kept per key over a stream of orders.

A day's sum counts as one amount, so a day is closed only when the watermark has passed its end:
until then its sum waits in the key's state. The days that a key is still waiting for are a map
from day to sum, where it stands is one value. What a key's state holds is thus bounded by the
days that the watermark lags behind, however many orders there are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from tallyworks.sources.shipping import ship

NEVER = dt.date(1900, 1, 1)
_EPOCH = dt.date(1970, 1, 1)
_DAY_MS = 86_400_000
_MONEY = "decimal(14,2)"


class CooldownProcessor(StatefulProcessor):
    """Sums per day until the day is over, then the rule of the batch form day by day."""

    def __init__(self, limit: str, cap: int, wait_days: int):
        self.goal = int(Decimal(limit).quantize(Decimal("0.01"), ROUND_HALF_UP) * 100)
        self.cap, self.wait_days = cap, wait_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # days are numbers since 1970 and amounts whole cents
        self.days = handle.getMapState("open_days", "day int", "cents long")
        self.stand = handle.getValueState("stand", "presents int, cents long, latest int")
        self.timer = handle.getValueState("timer", "at_ms long")

    def _wake(self, day: int) -> None:
        """Wake the key when ``day`` is over, unless it is woken before. A key has one timer."""
        at = (day + 1) * _DAY_MS
        if self.timer.exists():
            (known,) = self.timer.get()
            if known <= at:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        new: dict[int, int] = {}
        for batch in rows:
            for day, cents in batch.groupby("day_number")["cents"].sum().items():
                new[int(day)] = new.get(int(day), 0) + int(cents)
        for day, cents in new.items():
            before = self.days.getValue((day,))[0] if self.days.containsKey((day,)) else 0
            self.days.updateValue((day,), (before + cents,))
        self._wake(min(new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        over = timerValues.getCurrentWatermarkInMs() // _DAY_MS
        self.timer.clear()
        days = sorted(day for (day,) in self.days.keys())
        ended = [day for day in days if day < over]
        if len(ended) < len(days):
            self._wake(days[len(ended)])
        if not ended:
            return
        presents, total, latest = self.stand.get() if self.stand.exists() else (0, 0, (NEVER - _EPOCH).days)
        for day in ended:
            (cents,) = self.days.getValue((day,))
            self.days.removeKey((day,))
            if presents < self.cap and day - latest > self.wait_days:
                total += cents
                if total >= self.goal:
                    presents, total, latest = presents + 1, 0, day
        self.stand.update((presents, total, latest))
        yield pd.DataFrame(
            {
                "no_key": [key[0]],
                "key": [key[1]],
                "presents": [presents],
                "open_sum": [Decimal(total).scaleb(-2)],
                "latest_present": [_EPOCH + dt.timedelta(days=latest)],
                "closed_until": [_EPOCH + dt.timedelta(days=ended[-1])],
            }
        )

    def close(self) -> None:
        pass


def stream_reset_accumulator_cooldown(
    orders: DataFrame,
    key: str,
    time: str,
    amount: str,
    limit: str,
    cap: int = 10,
    wait_days: int = 10,
    lateness: str = "1 day",
) -> DataFrame:
    """Stream of (key, presents, open_sum, latest_present, closed_until) as days are closed.

    A key's newest row equals the batch form's for the days up to ``closed_until``. Orders later
    than ``lateness`` behind the newest one are left out, as any watermark does. A null amount
    adds nothing and a null key is a key like others. Needs the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    ship(orders.sparkSession)
    moment = F.col(time).cast("timestamp")
    cents = F.coalesce((F.col(amount).cast(_MONEY) * 100).cast("long"), F.lit(0).cast("long"))
    kind = orders.schema[key].dataType
    # a null cannot group this operator's state: those rows go under a mark of their own
    instead = F.lit("1970-01-01" if isinstance(kind, (DateType, TimestampType, TimestampNTZType)) else "0")
    rows = orders.select(
        F.col(key).isNull().alias("no_key"),
        F.coalesce(F.col(key), instead.cast(kind)).alias("key"),
        moment.alias("moment"),
        F.datediff(moment.cast("date"), F.lit(_EPOCH)).alias("day_number"),
        cents.alias("cents"),
    ).withWatermark("moment", lateness)
    result = StructType.fromDDL(
        f"no_key boolean, key {kind.simpleString()}, presents int, open_sum {_MONEY}, "
        "latest_present date, closed_until date"
    )
    stands = rows.groupBy("no_key", "key").transformWithStateInPandas(
        CooldownProcessor(limit, cap, wait_days), result, "Update", "EventTime"
    )
    return stands.select(
        F.when(~F.col("no_key"), F.col("key")).alias(key), "presents", "open_sum", "latest_present", "closed_until"
    )
