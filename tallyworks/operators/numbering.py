"""Row numbers and batch numbers for tables of any size.

``row_number() OVER (ORDER BY ...)`` moves a whole table into one task. Here the
rows are range-partitioned and sorted by the ordering columns, written once, and
each row's number is its place inside its partition plus the size of the
partitions before it. A key holding a large share of the rows is spread over
several partitions. Numbers that restart with a key are counted while a partition is
written; a partition that begins inside a key takes the key's rows so far from the
partitions before it, one row each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, MapType, StructField, StructType

from tallyworks.sources.shipping import ship
from tallyworks.sources.storage import freeze

_SLOT_BITS = 33  # monotonically_increasing_id: partition above, row below
_PLACE_MASK = (1 << _SLOT_BITS) - 1


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(name) if isinstance(name, str) else name for name in names]


def lay_out(
    df: DataFrame,
    order_by: Sequence[str | Column],
    slot: str = "_slot",
    parts: int | None = None,
    runs: Sequence[str] = (),
) -> DataFrame:
    """Store ``df`` sorted over range partitions, with an ascending ``slot`` per row.

    A hash of the row ends the ordering: rows with equal ordering columns are
    spread over partitions too, and keep their order when a task is repeated.
    ``runs`` adds ``_run``, the place of a row among its neighbours with equal ``runs``
    columns in the same partition, from 0.
    """
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    order = [*_columns(order_by), F.xxhash64(*hashed)]
    laid = df.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    if runs:
        ship(df.sparkSession)
        schema = StructType([*df.schema.fields, StructField("_run", LongType(), False)])
        laid = laid.mapInArrow(_numbered_runs(df.schema, tuple(runs)), schema)
    return freeze(laid.withColumn(slot, F.monotonically_increasing_id()), "layout")


def _differs(before: pa.Array, after: pa.Array, floating: bool) -> np.ndarray:
    """Whether two aligned arrays differ, place by place; nulls and NaNs are equal to themselves."""
    differ = pc.fill_null(pc.not_equal(before, after), False)
    if floating:
        both = pc.fill_null(pc.and_(pc.is_nan(before), pc.is_nan(after)), False)
        differ = pc.and_not(differ, both)
    return pc.or_(differ, pc.xor(before.is_null(), after.is_null())).to_numpy(zero_copy_only=False)


def with_starts(
    batches: Iterator[pa.RecordBatch], schema: StructType, keys: Sequence[str]
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted batches, each with a mark on every row whose keys differ from those of the row before.

    Holds one batch and the keys of the last row.
    """
    floating = [isinstance(schema[key].dataType, (FloatType, DoubleType)) for key in keys]
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        starts = np.zeros(n, bool)
        columns = [batch.column(schema.fieldNames().index(key)) for key in keys]
        for place, column in enumerate(columns):
            if last is None:
                starts[0] = True
            else:
                starts[:1] |= _differs(last[place], column.slice(0, 1), floating[place])
            starts[1:] |= _differs(column.slice(0, n - 1), column.slice(1), floating[place])
        last = [column.slice(n - 1) for column in columns]
        yield batch, starts


def _numbered_runs(schema: StructType, keys: Sequence[str]):
    """Task function adding ``_run``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = 0  # rows so far of the run that the last batch ended in
        for batch, starts in with_starts(batches, schema, keys):
            places = np.arange(batch.num_rows)
            begun = np.maximum.accumulate(np.where(starts, places, -1))
            runs = np.where(begun < 0, length + places, places - begun)
            length = int(runs[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(runs, pa.int64())], [*schema.fieldNames(), "_run"]
            )

    return run


def slot_partition(slot: str = "_slot") -> Column:
    return F.shiftright(F.col(slot), _SLOT_BITS)


def slot_place(slot: str = "_slot") -> Column:
    return F.col(slot).bitwiseAND(F.lit(_PLACE_MASK).cast("long"))


def running_offset(totals: DataFrame, by: str, amount: str, name: str, within: Sequence[str] = ()):
    """Sum of ``amount`` over the rows before each row.

    Meant for one row per range partition, so its size is the number of
    partitions and not the number of data rows.
    """
    window = Window.partitionBy(*within).orderBy(by)
    before = F.sum(amount).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return totals.withColumn(name, F.coalesce(before, F.lit(0)))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "rn",
    within: Sequence[str] = (),
) -> DataFrame:
    """Exact 1..n numbering of ``df``, restarted for every value of ``within``.

    The rows are sorted once and meet nothing but one row per partition: the rows before the
    partition or, with ``within``, the rows of its first key before it.
    """
    runs = ["_run"] if within else []
    stored = lay_out(df, [*within, *order_by], runs=within).withColumn("_part", slot_partition())
    if within:
        offsets = _carried_runs(stored, within)
        place = F.col("_run") + 1 + F.when(F.col("_run") == slot_place(), F.col("_before")).otherwise(0)
    else:
        counts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        offsets = running_offset(counts, "_part", "_rows", "_before").drop("_rows")
        place = F.col("_before") + slot_place() + 1
    # one row per range partition: small by construction, safe to send everywhere
    numbered = stored.join(F.broadcast(offsets), "_part").withColumn("_number", place)
    return numbered.drop(*runs, "_slot", "_part", "_before").select(
        *df.columns, F.col("_number").alias(name)
    )


def _carried_runs(stored: DataFrame, within: Sequence[str]) -> DataFrame:
    """For each partition, how many rows of its first key lie in the partitions before it.

    A segmented scan over one row per partition: the sum of the last runs of the partitions
    before, as far back as these hold nothing but the same key.
    """
    key = F.struct(*within)
    ends = stored.groupBy("_part").agg(
        F.min_by(key, "_slot").alias("first"),
        F.max_by(key, "_slot").alias("last"),
        (F.max_by("_run", "_slot") + 1).alias("tail"),
        F.count(F.lit(1)).alias("n"),
    )
    order = Window.orderBy("_part")
    goes_on = F.col("first").eqNullSafe(F.lag("last").over(order))
    taken = F.when(goes_on, F.lag("tail").over(order)).otherwise(0)
    whole = F.lag(F.col("tail") == F.col("n")).over(order)  # nothing but one key
    segment = F.count_if(~(F.col("goes_on") & F.coalesce("whole", F.lit(False)))).over(order)
    return (
        ends.select("_part", goes_on.alias("goes_on"), taken.alias("taken"), whole.alias("whole"))
        .withColumn("segment", segment)
        .select("_part", F.sum("taken").over(Window.partitionBy("segment").orderBy("_part")).alias("_before"))
    )


def assign_batches(
    df: DataFrame,
    key: str | Sequence[str],
    size: int,
    offset: int = 1,
    name: str = "batch_no",
) -> DataFrame:
    """Batch of every row in key order. ``offset=0`` makes the first batch one row short."""
    keys = [key] if isinstance(key, str) else list(key)
    numbered = number_rows(df, keys, "_rn")
    return numbered.withColumn(
        name, F.expr(f"(_rn - {int(offset)}) div {int(size)}")
    ).drop("_rn")


def split_batch(
    batches: DataFrame, batch_no: int, key: str, parts: int = 100, name: str = "batch_no"
) -> DataFrame:
    """Re-divide one batch into about ``parts`` smaller ones, numbered after the last batch.

    A batch of n rows gets batches of (n-1)/parts+1 rows: 10000, then 100, then 1.
    """
    chosen = F.col(name) == batch_no
    facts = batches.agg(
        F.count_if(chosen).alias("n"), F.max(name).alias("last")
    ).first()
    if not facts["n"]:
        return batches
    size = (facts["n"] - 1) // parts + 1
    renumbered = number_rows(batches.where(chosen), [key], "_rn").withColumn(
        name, F.expr(f"(_rn - 1) div {size} + {facts['last'] + 1}")
    )
    return batches.where(~chosen).unionByName(renumbered.drop("_rn"))


def slices(df: DataFrame, size: int, rn: str = "rn") -> DataFrame:
    """Rows in each export slice; numbers start at 1, so slice 0 is one row short."""
    return df.groupBy(F.expr(f"{rn} div {int(size)}").alias("slice")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
