from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyworks.operators import stored_jobs
from tallyworks.operators.accumulators import reset_accumulator, reset_accumulator_cooldown
from tallyworks.sources.storage import load, scratch_path
from tallyworks.sources.stored import TableStore
from tallyworks.streaming.awards import stream_reset_accumulator
from tallyworks.streaming.cooldown import stream_reset_accumulator_cooldown
from tallyworks.streaming.copying import stream_copy
from tallyworks.streaming.repricing import reprice_batch, stream_reprice

D = Decimal
FOLDER = "/root/testdata/sf0.001"


def test_stream_copy_only_takes_new_files(spark):
    orders = load(spark, FOLDER, "orders").select("o_orderkey", "o_custkey")
    source, target, mark = (scratch_path(spark, name) for name in ("in", "out", "mark"))
    middle = orders.agg(F.floor(F.avg("o_orderkey"))).first()[0]
    for part in (orders.where(F.col("o_orderkey") < middle), orders.where(F.col("o_orderkey") >= middle)):
        part.write.mode("append").parquet(source)
        for _ in range(2):  # the second start finds nothing new
            stream_copy(spark, source, orders.schema, target, mark, orders.columns).awaitTermination(120)
        copied = spark.read.parquet(target)
        assert as_set(copied) == as_set(spark.read.parquet(source))


def test_stream_awards_equal_the_batch(spark):
    orders = load(spark, FOLDER, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(14,2)").alias("amount"),
    )
    source, mark = scratch_path(spark, "in"), scratch_path(spark, "mark")
    seen: dict[int, tuple[int, Decimal]] = {}

    def remember(batch, _):
        seen.update({r["customer_id"]: (r["presents"], r["open_sum"]) for r in batch.collect()})

    last = dt.date(1995, 1, 1)
    for cut in (dt.date(1997, 1, 1), dt.date(1999, 6, 1), dt.date(2100, 1, 1)):
        part = orders.where((F.col("day") >= F.lit(last)) & (F.col("day") < F.lit(cut)))
        part.write.mode("append").parquet(source)
        last = cut
        stream = stream_reset_accumulator(
            spark.readStream.schema(orders.schema).parquet(source),
            "customer_id", ["day", "order_id"], "amount", "1000000",
        )
        query = (
            stream.writeStream.outputMode("update").foreachBatch(remember)
            .option("checkpointLocation", mark).trigger(availableNow=True).start()
        )
        query.awaitTermination(180)
    batch = reset_accumulator(orders, "customer_id", ["day", "order_id"], "amount", "1000000", keep_zero=True)
    assert {k: v[0] for k, v in seen.items()} == {r["customer_id"]: r["presents"] for r in batch.collect()}


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def test_stream_cooldown_equals_the_batch_after_restarts(spark):
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    orders = load(spark, FOLDER, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("timestamp").alias("at"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("amount"),
    )
    # days split between micro-batches, and some null amounts
    orders = orders.unionByName(orders.where("customer_id % 3 = 0").withColumn("amount", F.lit(None).cast("decimal(14,2)")))
    source, mark = scratch_path(spark, "in"), scratch_path(spark, "mark")
    seen = {}

    def remember(batch, _):
        for row in batch.collect():
            if row["customer_id"] is not None:
                seen[row["customer_id"]] = (row["presents"], row["open_sum"], row["latest_present"])

    cuts = [dt.datetime(1990, 1, 1), dt.datetime(1996, 5, 3), dt.datetime(1999, 6, 1), dt.datetime(2100, 1, 1)]
    for low, high in zip(cuts, cuts[1:]):
        part = orders.where((F.col("at") >= F.lit(low)) & (F.col("at") < F.lit(high)))
        part.write.mode("append").parquet(source)
        if high == cuts[-1]:  # a later moment closes the last days
            spark.createDataFrame([(None, dt.datetime(2100, 1, 1), D(0))], orders.schema).write.mode("append").parquet(source)
        stream = stream_reset_accumulator_cooldown(
            spark.readStream.schema(orders.schema).parquet(source), "customer_id", "at", "amount", "300000"
        )
        (
            stream.writeStream.outputMode("update").foreachBatch(remember)
            .option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination(300)
        )
    batch = reset_accumulator_cooldown(orders, "customer_id", "at", "amount", "300000")
    wanted = {r["customer_id"]: (r["presents"], r["open_sum"], r["latest_present"]) for r in batch.collect()}
    assert seen == wanted and max(n for n, _, _ in wanted.values()) > 1


def test_price_stream_changes_each_row_once(spark, rows):
    store = TableStore(spark, scratch_path(spark, "store"))
    stored_jobs.store_table(store, "t", spark.range(40).select("id", F.lit(10).cast("decimal(14,4)").alias("p")), "id")
    source, mark = scratch_path(spark, "in"), scratch_path(spark, "mark")
    schema = "id long, factor decimal(6,2)"

    def run():
        changes = spark.readStream.schema(schema).parquet(source)
        stream_reprice(changes, store, "t", "id", "p", "factor", mark, "rise").awaitTermination(120)
        return {r["id"]: r["p"] for r in store.read("t").where("p <> 10").collect()}

    rows(schema, (1, D("1.2")), (2, D("2")), (2, D("1.5")), (99, D("3")), (None, D("3")), (5, None)).write.parquet(source)
    assert run() == run() == {1: D(12), 2: D(30)}
    rows(schema, (1, D("2"))).write.mode("append").parquet(source)
    assert run() == {1: D(24), 2: D(30)}
    # a batch handed over again after a stop
    again = rows(schema, (1, D("2")))
    last = store.notes("rise")["last_batch"]
    assert not reprice_batch(store, "t", again, last, "id", "p", "factor", "rise") and run() == {1: D(24), 2: D(30)}
    assert reprice_batch(store, "t", again, last + 1, "id", "p", "factor", "rise")


def test_stopped_price_batch_is_applied_when_handed_over_again(spark, rows, monkeypatch):
    store = TableStore(spark, scratch_path(spark, "store"))
    stored_jobs.store_table(store, "t", spark.range(4).select("id", F.lit(10).cast("decimal(14,4)").alias("p")))
    batch = ("t", rows("id long, factor decimal(6,2)", (1, D("2"))), 0, "id", "p", "factor", "rise")

    def stop(self, record):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_commit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            reprice_batch(store, *batch)
    assert store.read("t").where("p <> 10").isEmpty()
    assert reprice_batch(store, *batch) and not reprice_batch(store, *batch)
    assert as_set(store.read("t").where("p <> 10")) == [(1, D("20.0000"))]
