"""Restartable copies and changes of large tables.

A run writes a folder of its own, and the run counts from the moment its commit
marker exists. An interrupted run leaves a folder without the marker, which no
reader looks at, so a restart neither loses nor repeats rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from decimal import Decimal
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources.storage import has_data, list_folders


def copy_table(source: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    """Write the named columns to ``path`` in one job and return the copy."""
    chosen = source.select(*columns)
    chosen.write.mode("overwrite").parquet(path)
    return source.sparkSession.read.schema(chosen.schema).parquet(path)


def finished_runs(spark: SparkSession, root: str) -> list[str]:
    """Folders of the runs that were committed, in order."""
    return [path for path in list_folders(spark, root) if has_data(spark, path)]


def read_runs(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows of the committed runs."""
    paths = finished_runs(spark, root)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


class Reached(NamedTuple):
    """How far the committed runs have come: their rows, and their highest key."""

    rows: int
    key: Any

    def with_run(self, run: Reached) -> Reached:
        keys = [key for key in (self.key, run.key) if key is not None]
        return Reached(self.rows + run.rows, max(keys) if keys else None)

    def rest(self, source: DataFrame, key: str) -> DataFrame:
        """Rows of ``source`` above the highest key; those without a key only before the first run."""
        if not self.rows:
            return source
        return source.where(F.col(key).isNotNull() if self.key is None else F.col(key) > self.key)


def reached(spark: SparkSession, root: str, schema, key: str) -> Reached:
    if not finished_runs(spark, root):
        return Reached(0, None)
    return Reached(*read_runs(spark, root, schema).agg(F.count(F.lit(1)), F.max(key)).first())


def write_run(df: DataFrame, root: str, key: str) -> Reached:
    """Write one run; its rows are counted on the way."""
    ordinal = len(list_folders(df.sparkSession, root))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(key).alias("key")).write.parquet(
        f"{root}/run-{ordinal:06d}-{uuid.uuid4().hex[:8]}"
    )
    return Reached(seen.get["rows"], seen.get["key"])


def resumable_copy(source: DataFrame, root: str, key: str) -> DataFrame:
    """Copy the rows with a key above the highest one already copied; all at first.

    Rows without a key have no place in the order: they are copied with the first run.
    """
    spark = source.sparkSession
    write_run(reached(spark, root, source.schema, key).rest(source, key), root, key)
    return read_runs(spark, root, source.schema)


def purge_before(df: DataFrame, date_col: str, cutoff) -> DataFrame:
    """What is left after deleting rows dated before ``cutoff``; undated rows stay."""
    day = F.col(date_col)
    return df.where((day >= F.lit(cutoff)) | day.isNull())


def fill_unset(
    df: DataFrame, key: str, col: str, value: Column, resume: bool = True, unset: str = ""
) -> DataFrame:
    """Give ``col`` a value in all rows, or only from the first key not yet filled.

    Resuming starts at the lowest unset key and also refills set rows after it.
    """
    if not resume:
        return df.withColumn(col, value)
    start = df.where(F.col(col) == unset).agg(F.min(key)).scalar()
    return df.withColumn(col, F.when(F.col(key) >= start, value).otherwise(F.col(col)))


def reprice_once(
    source: DataFrame, key: str, col: str, factor: Decimal, root: str, job: str, upto=None
) -> DataFrame:
    """Multiply ``col`` exactly once per row, however often the job is restarted.

    Each call handles the keys after the last committed run, up to ``upto`` when
    given, and returns the whole table: changed rows of committed runs, the rest
    as in ``source``. The runs are the job's ledger. ``job`` names one price
    change; a later change needs a new name and starts from the new table. Rows
    without a key are handled with the first run.
    """
    spark = source.sparkSession
    folder = f"{root}/job={job}"
    kind = source.schema[col].dataType.simpleString()
    before = reached(spark, folder, source.schema, key)
    todo = before.rest(source, key)
    if upto is not None:
        todo = todo.where((F.col(key) <= upto) | F.col(key).isNull())
    now = before.with_run(write_run(todo.withColumn(col, (F.col(col) * F.lit(factor)).cast(kind)), folder, key))
    return read_runs(spark, folder, source.schema).unionByName(now.rest(source, key))
