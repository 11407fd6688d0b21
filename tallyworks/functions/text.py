"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlay_text(value: Column, start: int, length: int, replacement: str) -> Column:
    """Drop ``length`` characters from position ``start`` and put text in their place."""
    return F.overlay(value, F.lit(replacement), F.lit(start), F.lit(length))


def contains_literal(value: Column, text: str) -> Column:
    """LIKE with wildcards taken literally: ``%`` and ``_`` in ``text`` match themselves."""
    escaped = text
    for special in ("!", "%", "_"):
        escaped = escaped.replace(special, "!" + special)
    return F.like(value, F.lit(f"%{escaped}%"), F.lit("!"))


def matches_none(value: Column, patterns: Sequence[str]) -> Column:
    """True when no LIKE pattern matches; null values are not matched either way."""
    condition = F.lit(True)
    for pattern in patterns:
        condition = condition & ~value.like(pattern)
    return condition


def text_length(value: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(value))


def pieces(value: Column, lengths: Column) -> Column:
    """The distinct substrings of ``value`` having one of ``lengths``."""
    total = F.length(value)
    fitting = F.filter(lengths, lambda size: (size > 0) & (size <= total))
    return F.array_distinct(
        F.flatten(
            F.transform(
                fitting,
                lambda size: F.transform(
                    F.sequence(F.lit(1), total - size + 1),
                    lambda start: F.substring(value, start, size),
                ),
            )
        )
    )
