"""Key ranges that cut a table into batches.

``key_range_batches`` with repeated keys is the hard one: a batch takes at least
``size`` rows and all rows of its last key, so every cut depends on the one
before. What a chunk of sorted keys needs to know is only how many rows the batch
that is open at its beginning has; what it passes on is how many the one open at
its end has. So a chunk is a function from one to the other, constant on ranges
but for a lowest one that the batch passes through whole:

1. as the sorted keys are stored, every chunk works out its function, following
   each possible first cut to the chunk's end by doubling;
2. neighbouring functions are composed, array by array, until one is left, and on
   the way back every chunk learns the open batch it begins with;
3. every chunk lists its own cuts.

No task holds more than one chunk of keys or a bounded number of function values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyworks.operators.numbering import number_rows
from tallyworks.sources.shipping import ship
from tallyworks.sources.storage import freeze

CHUNK_KEYS = 1_000_000
FANOUT = 1024
BUDGET = 8_000_000
_FUNCTION = "chunk long, upto long, rows long, needs array<long>, outs array<long>"


def key_range_batches(
    df: DataFrame,
    key: str,
    size: int,
    unique: bool = False,
    chunk_keys: int = CHUNK_KEYS,
    fanout: int = FANOUT,
    budget: int = BUDGET,
) -> DataFrame:
    """(batch, lo, hi, n): ranges of at least ``size`` rows, equal keys together.

    The last range may be smaller. Gaps between keys do not matter; rows without a key are left
    out. A chunk has ``chunk_keys`` keys at most; a task composes ``fanout`` functions with
    ``budget`` values at most, two functions at least. None of the three changes the result.
    """
    if unique:
        numbered = number_rows(df.select(key), [key], "_rn")
        return numbered.groupBy(F.expr(f"(_rn - 1) div {int(size)}").alias("batch")).agg(
            F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")
        )
    ship(df.sparkSession)
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    laid = counts.repartitionByRange("_key").sortWithinPartitions("_key")
    columns = [StructField(f.name, f.dataType) for f in laid.schema]
    schema = StructType([*columns, *StructType.fromDDL(_FUNCTION).fields])
    stored = freeze(laid.mapInArrow(_chunks(schema, int(size), chunk_keys), schema), "key_chunks")
    functions = stored.where(F.col("needs").isNotNull()).select("chunk", "upto", "rows", "needs", "outs")
    entries = _entries(functions, fanout, max(budget, 2 * int(size)))
    keys = stored.where(F.col("needs").isNull()).select("chunk", "_key", "n")
    found = StructType(
        [
            *[StructField(name, LongType()) for name in ("chunk", "place", "n")],
            *[StructField(name, laid.schema["_key"].dataType) for name in ("lo", "hi")],
        ]
    )
    cuts = freeze(
        keys.groupBy("chunk").cogroup(entries.groupBy("chunk")).applyInArrow(_listed(found, int(size)), found), "cuts"
    )
    return _numbered(cuts)


def _cut_after(sums: np.ndarray, size: int) -> np.ndarray:
    """For each place of running row counts the first place where a batch begun there is full, or one past the end."""
    return np.searchsorted(sums, sums + size)


def _followed(to: np.ndarray, first: int) -> np.ndarray:
    """All places from ``first`` on that are reached by going from each to the next; twice as many each time."""
    last = len(to) - 1
    places, to = np.array([first] if first <= last else [], np.int64), np.append(to, last + 1)
    while len(places):
        more = to[places]
        more = more[more <= last]
        if not len(more):
            break
        places, to = np.concatenate([places, more]), to[to]
    return places


def _function(counts: np.ndarray, size: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """A chunk as a function of the open batch's rows: (upto, rows, needs, outs).

    Below ``upto`` the open batch passes through and grows by ``rows``. From each of ``needs``
    (ascending) on, the open batch at the end has the rows in ``outs``.
    """
    sums = np.concatenate([[0], np.cumsum(counts)])
    last, total = len(counts), int(sums[-1])
    to = _cut_after(sums, size)
    end = np.where(to <= last, to, np.arange(last + 1))
    while not np.array_equal(end, end[end]):  # follows cuts twice as far each time
        end = end[end]
    # the first cut may be at any key up to the one that fills a batch begun with the chunk
    firsts = np.arange(1, min(int(to[0]), last) + 1)[::-1]
    needs, outs = np.maximum(size - sums[firsts], 0), total - sums[end[firsts]]
    keep = np.append(True, outs[1:] != outs[:-1])
    upto = int(needs[0]) if len(needs) else size
    return upto, total, needs[keep], outs[keep]


@dataclass
class _Step:
    upto: int
    rows: int
    needs: np.ndarray
    outs: np.ndarray

    def __call__(self, entering):
        """Rows of the batch open at the end, for rows open at the beginning (a number or an array)."""
        passing = np.asarray(entering) < self.upto
        if not len(self.needs):
            return np.asarray(entering) + self.rows
        at = np.maximum(np.searchsorted(self.needs, entering, side="right") - 1, 0)
        return np.where(passing, np.asarray(entering) + self.rows, self.outs[at])

    def then(self, after: _Step) -> _Step:
        """Both steps as one."""
        upto = max(min(self.upto, after.upto - self.rows), 0)
        # what passes through here and not there: the ranges of ``after``, moved down
        moved = after.needs - self.rows
        inside = (moved < self.upto) & (np.append(moved[1:], np.iinfo(np.int64).max) > 0)
        needs = np.concatenate([np.maximum(moved[inside], 0), self.needs])
        outs = np.concatenate([after.outs[inside], after(self.outs)]).astype(np.int64)
        keep = np.append(True, outs[1:] != outs[:-1])[: len(outs)]
        return _Step(upto, self.rows + after.rows, needs[keep], outs[keep])


def _steps(table: pa.Table) -> list[tuple[int, _Step]]:
    steps = []
    for row in table.sort_by("chunk").to_batches():
        numbers = zip(*[row.column(name).to_pylist() for name in ("chunk", "upto", "rows")])
        for (chunk, upto, rows), needs, outs in zip(numbers, row.column("needs"), row.column("outs")):
            steps.append((chunk, _Step(upto, rows, needs.values.to_numpy(), outs.values.to_numpy())))
    return steps


def _chunks(schema: StructType, size: int, chunk_keys: int):
    """Task function: sorted keys with their chunk, and a row for each chunk's function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, counts, room = TaskContext.get().partitionId() << 33, [], chunk_keys

        def function(kind: pa.DataType) -> pa.RecordBatch:
            upto, rows, needs, outs = _function(np.concatenate(counts), size)
            lists = pa.list_(pa.int64())
            columns = [pa.nulls(1, kind), pa.nulls(1, pa.int64())]
            columns += [pa.array([value], pa.int64()) for value in (chunk, upto, rows)]
            columns += [pa.array([values.tolist()], lists) for values in (needs, outs)]
            return pa.RecordBatch.from_arrays(columns, schema.fieldNames())

        kind = None
        for batch in batches:
            kind, at = batch.column("_key").type, 0
            while at < batch.num_rows:
                if not room:
                    yield function(kind)
                    chunk, counts, room = chunk + 1, [], chunk_keys
                some = batch.slice(at, room)
                n = some.num_rows
                counts.append(some.column("n").to_numpy())
                room, at = room - n, at + n
                nothing = [pa.nulls(n, pa.int64())] * 2 + [pa.nulls(n, pa.list_(pa.int64()))] * 2
                columns = [*some.columns, pa.array(np.full(n, chunk)), *nothing]
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())
        if counts:
            yield function(kind)

    return run


def _entries(functions: DataFrame, fanout: int, budget: int) -> DataFrame:
    """(chunk, entry): rows of the batch open at each chunk's beginning."""
    # one row per chunk; a function weighs its values, or its share of the fanout
    weight = F.greatest(F.size("needs").cast("long"), F.lit(-(-budget // fanout)))
    order = Window.orderBy("chunk")
    weighed = functions.select("chunk", weight.alias("weight")).withColumns(
        {"rank": F.row_number().over(order) - 1, "before": F.sum("weight").over(order) - F.col("weight")}
    )
    # two functions at least, so that every level has half as many at most
    pairs = weighed.groupBy(F.expr("rank div 2")).agg(
        F.min("chunk").alias("low"), F.max("chunk").alias("high"), F.min("before").alias("before")
    )
    both = F.explode(F.array_distinct(F.array("low", "high"))).alias("of")
    groups = freeze(pairs.select(both, F.expr(f"before div {budget}").alias("group")), "chunk_groups")
    last = groups.agg(F.max("group"), F.min("group")).first()
    grouped = functions.join(groups.select("of", "group"), F.col("chunk") == F.col("of")).drop("of")
    schema = "chunk long, entry long"

    def walk(steps: list[tuple[int, _Step]], entry: int) -> pa.Table:
        chunks, entries = [], []
        for chunk, step in steps:
            chunks.append(chunk)
            entries.append(entry)
            entry = int(step(entry))
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "entry": pa.array(entries, pa.int64())})

    if last[0] is None or last[0] == last[1]:
        return freeze(grouped.groupBy("group").applyInArrow(lambda table: walk(_steps(table), 0), schema), "entries")

    def composed(table: pa.Table) -> pa.Table:
        (_, whole), *rest = _steps(table)
        for _, step in rest:
            whole = whole.then(step)
        row = {"chunk": table.column("group")[0].as_py(), "upto": whole.upto, "rows": whole.rows}
        return pa.Table.from_pylist(
            [{**row, "needs": whole.needs.tolist(), "outs": whole.outs.tolist()}],
            pa.schema([(n, pa.int64()) for n in row] + [(n, pa.list_(pa.int64())) for n in ("needs", "outs")]),
        )

    above = freeze(grouped.groupBy("group").applyInArrow(composed, _FUNCTION), "composed")
    entering = _entries(above, fanout, budget).withColumnRenamed("chunk", "group")
    return freeze(
        grouped.groupBy("group")
        .cogroup(entering.groupBy("group"))
        .applyInArrow(lambda left, right: walk(_steps(left), right.column("entry")[0].as_py()), schema),
        "entries",
    )


def _listed(found: StructType, size: int):
    """Function of a chunk's keys and its entry: the chunk's cuts, and a last row for what stays open.

    A cut has its place in the chunk from 0 on, the rows of its batch and its keys; ``lo`` is null
    where the batch began in an earlier chunk. The last row has place -1, the number of cuts as
    ``n``, as ``hi`` the chunk's last key and as ``lo`` the first key of the open batch if it is
    in this chunk; the rows left open are place -2.
    """

    def run(keys: pa.Table, entries: pa.Table) -> pa.Table:
        keys = keys.sort_by("_key")
        entry = entries.column("entry")[0].as_py()
        sums = np.concatenate([[0], np.cumsum(keys.column("n").to_numpy())])
        last = len(sums) - 1
        cuts = _followed(np.minimum(_cut_after(sums, size), last + 1), int(np.searchsorted(sums, max(size - entry, 1))))
        starts = np.concatenate([[0], cuts])[: len(cuts) + 1]
        rows = np.diff(sums[np.concatenate([[0], cuts])]) if len(cuts) else np.zeros(0, np.int64)
        if len(rows):
            rows[0] += entry
        left = int(sums[last] - sums[starts[-1]]) + (0 if len(cuts) else entry)
        chunk = entries.column("chunk")[0].as_py()
        place = np.concatenate([np.arange(len(cuts)), [-1, -2]])
        n = np.concatenate([rows, [len(cuts), left]])
        column = keys.column("_key").combine_chunks()
        inside = lambda where, ok: column.take(pa.array(where, pa.int64(), mask=~np.asarray(ok)))
        # the first batch begins here only where none was open
        begins = np.concatenate([starts, [0]])
        here = np.concatenate([[entry == 0], np.ones(len(cuts), bool), [False]])
        here[len(cuts)] &= starts[-1] < last
        lo = inside(np.minimum(begins, last - 1), here)
        hi = inside(np.concatenate([cuts - 1, [last - 1, 0]]), np.append(np.ones(len(cuts) + 1, bool), False))
        arrays = [pa.array(np.full(len(place), chunk)), pa.array(place), pa.array(n)]
        return pa.table([*arrays, lo, hi], names=found.fieldNames())

    return run


def _numbered(cuts: DataFrame) -> DataFrame:
    """Batches numbered over all chunks, with the first key of those begun in an earlier chunk."""
    order = Window.orderBy("chunk")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # one row per chunk
    chunks = cuts.where("place = -1").select("chunk", F.col("n").alias("cuts"), "lo", "hi")
    chunks = chunks.select(
        F.col("chunk").alias("of"),
        F.coalesce(F.sum("cuts").over(before), F.lit(0)).alias("first"),
        F.last("lo", ignorenulls=True).over(before).alias("begun"),
        F.last("lo", ignorenulls=True).over(order).alias("open"),
        (F.col("chunk") == F.max("chunk").over(Window.partitionBy())).alias("ends"),
        "hi",
        "cuts",
    )
    listed = cuts.where("place >= 0").join(chunks.drop("hi", "cuts", "open", "ends"), F.col("chunk") == F.col("of"))
    full = listed.select(
        (F.col("first") + F.col("place")).alias("batch"), F.coalesce("lo", "begun").alias("lo"), "hi", "n"
    )
    left = cuts.where("place = -2 AND n > 0").select("chunk", "n")
    rest = left.join(chunks.where("ends"), F.col("chunk") == F.col("of")).select(
        (F.col("first") + F.col("cuts")).alias("batch"), F.col("open").alias("lo"), "hi", "n"
    )
    return full.unionByName(rest)


def fixed_stride_batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """(batch, lo, hi, n): key intervals of equal width from the lowest to the highest key.

    Empty intervals are listed too, with n = 0.
    """
    first, last = df.agg(F.min(key), F.max(key)).first()
    spark = df.sparkSession
    if first is None:
        return spark.createDataFrame([], "batch long, lo long, hi long, n long")
    batch = F.expr(f"({key} - {int(first)}) div {int(size)}")
    filled = df.where(F.col(key).isNotNull()).groupBy(batch.cast("long").alias("batch")).agg(
        F.count(F.lit(1)).alias("n")
    )
    every = spark.range((int(last) - int(first)) // size + 1).withColumnRenamed("id", "batch")
    return every.join(filled, "batch", "left").select(
        "batch",
        (F.col("batch") * size + int(first)).alias("lo"),
        (F.col("batch") * size + int(first) + size - 1).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
