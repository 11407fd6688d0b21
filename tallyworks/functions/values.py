"""Money, ladders and packed text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column, scale: int = 2) -> Column:
    """Exact amount: sums of it do not depend on row order."""
    return value.cast(f"decimal({12 + scale},{scale})")


def rounded(value: Column, scale: int = 2) -> Column:
    """A double rounded half up, by way of six exact places.

    Without them a quotient such as 127.805 would round by its binary noise.
    """
    return F.round(value.cast("decimal(24,6)"), scale)


def ratio(top: Column, bottom: Column) -> Column:
    """Double quotient; 0 when either side is null or zero."""
    usable = bottom.isNotNull() & (bottom != 0) & top.isNotNull() & (top != 0)
    return F.when(usable, top.cast("double") / bottom.cast("double")).otherwise(F.lit(0.0))


def ladder(steps: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """First step whose condition holds gives the value; null conditions do not hold."""
    chain = reduce(
        lambda acc, step: acc.when(*step) if acc is not None else F.when(*step), steps, None
    )
    return default if chain is None else chain.otherwise(default)


def pack(pairs: Sequence[tuple[str, Column]]) -> Column:
    """``k=v;k=v;`` in the given order; null as soon as one value is null."""
    return F.concat(*[F.concat(F.lit(f"{name}="), value, F.lit(";")) for name, value in pairs])


def unpack(packed: Column, name: str) -> Column:
    """The number stored under ``name`` in a packed text, null when it is not there."""
    return F.try_element_at(F.str_to_map(packed, F.lit(";"), F.lit("=")), F.lit(name)).try_cast(
        "double"
    )
