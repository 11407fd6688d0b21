"""Price changes that arrive as a stream, each applied to a stored table exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.sources.storage import freeze
from tallyworks.sources.stored import TableStore


def reprice_batch(
    store: TableStore, table: str, changes: DataFrame, batch_id: int, key: str, col: str, factor: str, stream: str
) -> bool:
    """Multiply ``col`` of every row by the factors of its key in one micro-batch, in one commit.

    The number of the last batch is noted in the same commit as its changes, so a batch that is
    handed over again changes nothing. Several changes of one key are multiplied together.
    Rows without a key or factor change nothing. Returns whether the table was changed now.
    """
    if store.notes(stream).get("last_batch", -1) >= batch_id:
        return False
    usable = changes.where(F.col(key).isNotNull() & F.col(factor).isNotNull())
    product = F.aggregate(
        F.collect_list(F.col(factor).cast("decimal(18,6)")),
        F.lit(1).cast("decimal(38,18)"),
        lambda total, one: (total * one).cast("decimal(38,18)"),
    )
    factors = freeze(usable.groupBy(key).agg(product.alias("_factor")), "factors")
    files = store.affected(table, keys=(key, factors.select(key)))
    kind = store.read(table).schema[col].dataType

    def raised(rows: DataFrame) -> DataFrame:
        new = (F.col(col) * F.coalesce("_factor", F.lit(1).cast("decimal(38,18)"))).cast(kind)
        return rows.join(factors, key, "left").withColumn(col, new).drop("_factor")

    with store.change(stream) as change:
        if files:
            change.rewrite(table, files, raised)
        change.notes["last_batch"] = batch_id
    return True


def stream_reprice(
    changes: DataFrame, store: TableStore, table: str, key: str, col: str, factor: str, checkpoint: str, stream: str
) -> StreamingQuery:
    """Apply a stream of price changes to a stored table, then stop.

    ``foreachBatch`` may hand a batch over again after a stop; the batch's number in the store's
    record keeps it from being applied twice. ``stream`` names the checkpoint: a new checkpoint
    counts its batches anew and needs a new name.
    """
    return (
        changes.writeStream.foreachBatch(
            lambda batch, number: reprice_batch(store, table, batch, number, key, col, factor, stream)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
