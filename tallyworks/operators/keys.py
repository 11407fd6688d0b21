"""Surrogate keys, session pairs, streaks and wide tables."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.operators.numbering import number_rows


def insert_new_keys(
    keys: DataFrame, incoming: DataFrame, value: str, key_id: str = "id"
) -> DataFrame:
    """``keys`` plus the trimmed, non-empty values it has not yet, numbered after its last id."""
    fresh = (
        incoming.select(F.trim(value).alias(value))
        .where(F.col(value) != "")
        .distinct()
        .join(keys.select(value), value, "left_anti")
    )
    last = keys.agg(F.coalesce(F.max(key_id), F.lit(0))).scalar()
    added = number_rows(fresh, [value], "_rn").select(
        (last + F.col("_rn")).cast("long").alias(key_id), value
    )
    return keys.select(F.col(key_id).cast("long").alias(key_id), value).unionByName(added)


def blocking_pairs(
    sessions: DataFrame, winners: Sequence[str], exempt: Sequence[str], at: dt.datetime
) -> DataFrame:
    """Lead blockers with the sessions they hold up.

    Kept: different logins, a victim login in ``winners``, a blocker login not in
    ``exempt``. ``act`` is set between 19:00 and 08:00.
    """
    columns = [c for c in sessions.columns if c not in ("blocking_id", "blocked_count")]
    blockers = sessions.where(
        (F.col("blocked_count") > 0)
        & F.col("blocking_id").isNull()
        & ~F.col("login").isin(*exempt)
    ).select(*[F.col(c).alias(f"blocker_{c}") for c in columns], "blocked_count")
    victims = sessions.where(F.col("login").isin(*winners)).select(
        *[F.col(c).alias(f"victim_{c}") for c in columns],
        F.col("blocking_id").alias("blocker_session_id"),
    )
    pairs = blockers.join(victims, "blocker_session_id").where(
        F.col("blocker_login") != F.col("victim_login")
    )
    act = at.time() >= dt.time(19) or at.time() < dt.time(8)
    return number_rows(pairs, ["blocker_session_id", "victim_session_id"], "row_num").withColumns(
        {"processed": F.lit(False), "act": F.lit(act)}
    )


def flag_log(sessions: DataFrame, pairs: DataFrame, at: dt.datetime) -> DataFrame:
    """The session snapshot as log rows of time ``at``, blockers acted on marked; no rows without pairs."""
    any_pair = pairs.agg(F.count(F.lit(1)) > 0).scalar()
    acted = (
        pairs.where("act")
        .select(F.col("blocker_session_id").alias("session_id"))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    return (
        sessions.where(any_pair)
        .join(acted, "session_id", "left")
        .withColumns(
            {
                "event_time": F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"),
                "flagged": F.coalesce("_hit", F.lit(False)),
            }
        )
        .drop("_hit")
    )


def longest_streak(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Longest run of consecutive days per key.

    Days are made distinct first, so the window of a key never holds more rows
    than the calendar has days, however many rows the key has.
    """
    days = df.select(*keys, F.to_date(date).alias("_day")).distinct()
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy("_day"))
    islands = days.withColumn("_island", F.date_sub("_day", rank))
    return (
        islands.groupBy(*keys, "_island")
        .agg(F.count(F.lit(1)).alias("_days"))
        .groupBy(*keys)
        .agg(F.max("_days").alias("max_consecutive_days"))
    )


def coalesce_wide(
    first: DataFrame,
    second: DataFrame,
    key: str,
    months: Sequence[int],
    take: Sequence[str],
    merge: Sequence[str],
) -> DataFrame:
    """Wide rows of ``first`` with gaps in the ``merge`` columns filled from ``second``.

    ``take`` and ``merge`` are name patterns such as ``limit_{}``.
    """
    kept = [pattern.format(k) for k in months for pattern in take]
    merged = [pattern.format(k) for k in months for pattern in merge]
    filler = second.select(key, *[F.col(c).alias(f"_{c}") for c in merged])
    return first.join(filler, key, "left").select(
        key, *kept, *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in merged]
    )


def max_per_table(frames: Mapping[str, DataFrame], name_pattern: str, column: str) -> DataFrame:
    """Largest value of the column whose name contains ``column``, for each fitting table."""
    rows = []
    for name in sorted(frames):
        found = [c for c in frames[name].columns if column in c]
        if re.fullmatch(name_pattern, name) and found:
            rows.append(
                frames[name]
                .agg(F.max(found[0]).cast("date").cast("string").alias("max_value"))
                .select(F.lit(name).alias("table_name"), "max_value")
            )
    if not rows:
        raise ValueError("no table fits the name pattern and has the column")
    return reduce(DataFrame.unionByName, rows)
