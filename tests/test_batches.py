from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from conftest import as_set
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyworks.operators import accumulators, copy_jobs, key_ranges, loading, numbering
from tallyworks.plans.bindings import Roles
from tallyworks.sources.storage import scratch_path

D = Decimal


# --- numbering ------------------------------------------------------------------


def test_numbers_follow_the_order_even_for_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("k"),
        (F.col("id") * 7919 % 30_011).alias("v"),
    )
    got = [tuple(r) for r in numbering.number_rows(df, ["k", "v"]).orderBy("rn").collect()]
    assert [(k, v) for k, v, _ in got] == sorted((k, v) for k, v, _ in got)
    assert [n for _, _, n in got] == list(range(1, 30_001))


def test_numbers_restart_within_a_key(rows):
    df = rows("k string, v int", *[(k, v) for k in ("a", "b", None) for v in (3, 1, 2)], ("a", 1))
    got = numbering.number_rows(df, ["v"], within=["k"]).collect()
    for key in ("a", "b", None):
        mine = sorted((r["rn"], r["v"]) for r in got if r["k"] == key)
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1))
        assert [v for _, v in mine] == sorted(v for _, v in mine)


def test_numbers_restart_within_keys_that_cross_partitions(spark):
    df = spark.range(20_000).select(
        # one key over many partitions, some small ones, NaN, null and text
        F.when(F.col("id") % 2 == 0, float("nan")).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5 * 1.0).alias("k"),
        F.when(F.col("id") % 3 == 0, "x").otherwise(None).alias("t"),
        (F.col("id") * 7919 % 20_011).alias("v"),
    )
    window = Window.partitionBy("k", "t").orderBy("v")
    got = numbering.number_rows(df, ["v"], "rn", within=["k", "t"])
    assert got.columns == ["k", "t", "v", "rn"]
    wanted = df.withColumn("rn", F.row_number().over(window).cast("long"))
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_numbers_within_a_key_meet_only_the_partitions(rows):
    plan = numbering.number_rows(rows("k int, v int", (1, 2), (1, 1)), ["v"], within=["k"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    # one join, and nothing is grouped by the key
    assert text.count("Join") == 1 and "Aggregate [k" not in text and "Aggregate [_part" in text


def test_numbering_descending_and_empty(rows):
    df = rows("v int", (1,), (3,), (2,))
    got = numbering.number_rows(df, [F.col("v").desc()]).collect()
    assert {r["v"]: r["rn"] for r in got} == {3: 1, 2: 2, 1: 3}
    assert numbering.number_rows(rows("v int"), ["v"]).collect() == []


@pytest.mark.parametrize(("offset", "sizes"), [(1, [3, 3, 1]), (0, [2, 3, 2])])
def test_batch_sizes(spark, offset, sizes):
    df = numbering.assign_batches(spark.range(10, 80, 10), "id", 3, offset)
    got = df.groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in got] == sizes


def test_split_goes_10000_100_1(spark):
    batches = numbering.assign_batches(spark.range(10_000), "id", 10_000)
    split = numbering.split_batch(batches, 0, "id")
    assert {r["count"] for r in split.groupBy("batch_no").count().collect()} == {100}
    again = numbering.split_batch(split, 1, "id")
    sizes = {r["batch_no"]: r["count"] for r in again.groupBy("batch_no").count().collect()}
    assert 1 not in sizes and sizes[2] == 100 and sizes[101] == 1 and len(sizes) == 199
    assert numbering.split_batch(split, 5000, "id").count() == 10_000


def test_slice_zero_is_one_short(spark):
    got = numbering.slices(spark.range(1, 2501).withColumnRenamed("id", "rn"), 1000)
    assert as_set(got) == [(0, 999), (1, 1000), (2, 501)]


# --- key ranges -----------------------------------------------------------------


def walk(keys, size):
    keys, out, at = sorted(keys), [], 0
    while at < len(keys):
        hi = keys[min(at + size, len(keys)) - 1]
        end = max(i for i, k in enumerate(keys) if k == hi) + 1
        out.append((len(out), keys[at], hi, end - at))
        at = end
    return out


@pytest.mark.parametrize("seed", range(4))
def test_key_ranges_equal_the_walk(spark, rows, seed):
    chance = random.Random(seed)
    top, size = chance.choice([40, 400]), chance.choice([1, 3, 17, 100])
    keys = [chance.randrange(top) for _ in range(chance.choice([1, 60, 900]))]
    keys += [5] * chance.choice([0, 300])
    df = rows("k int", *[(k,) for k in keys], (None,))
    got = key_ranges.key_range_batches(
        df, "k", size, chunk_keys=chance.choice([3, 11]), fanout=chance.choice([2, 3])
    )
    assert as_set(got) == walk(keys, size)


@pytest.mark.parametrize(("size", "chunk_keys", "fanout"), [(500, 7, 2), (90, 1, 3), (10_000, 5, 2), (1, 4, 1024)])
def test_batches_larger_than_chunks(rows, size, chunk_keys, fanout):
    chance = random.Random(size)
    keys = [chance.randrange(400) for _ in range(3000)]
    df = rows("k string", *[(f"{k:03d}",) for k in keys])
    got = key_ranges.key_range_batches(df, "k", size, chunk_keys=chunk_keys, fanout=fanout, budget=2 * size)
    assert as_set(got) == walk([f"{k:03d}" for k in keys], size)


def test_composed_steps_equal_the_steps_in_turn():
    for seed in range(300):
        chance = random.Random(seed)
        size = chance.choice([1, 3, 17, 60])
        chunks = [[chance.randrange(1, 25) for _ in range(chance.choice([1, 2, 9, 30]))] for _ in range(4)]
        steps = [key_ranges._Step(*key_ranges._function(np.array(c), size)) for c in chunks]
        whole = steps[0].then(steps[1]).then(steps[2].then(steps[3]))
        for start in range(size):
            at = start
            for chunk, step in zip(chunks, steps):
                passed = int(step(at))
                for n in chunk:
                    at = at + n if at + n < size else 0
                assert passed == at
            assert int(whole(start)) == at


def test_key_ranges_without_rows(rows):
    assert key_ranges.key_range_batches(rows("k int"), "k", 5).collect() == []
    assert key_ranges.fixed_stride_batches(rows("k int"), "k", 5).collect() == []


def test_unique_key_ranges_and_strides(rows):
    df = rows("k long", *[(k,) for k in (3, 4, 9, 20, 21)])
    ranges = key_ranges.key_range_batches(df, "k", 2, unique=True)
    assert as_set(ranges) == walk([3, 4, 9, 20, 21], 2)
    assert as_set(key_ranges.fixed_stride_batches(df, "k", 5)) == [
        (0, 3, 7, 2), (1, 8, 12, 1), (2, 13, 17, 0), (3, 18, 22, 2),
    ]


# --- accumulators ---------------------------------------------------------------


def presents(amounts, limit, cap):
    total = count = 0
    for amount in amounts:
        if count == cap:
            break
        total += amount
        if total >= limit:
            total, count = 0, count + 1
    return count


@pytest.mark.parametrize("parts", [None, 1, 3, 40])
def test_accumulator_does_not_depend_on_the_layout(rows, parts):
    chance = random.Random(3)
    values = []
    # nulls among the amounts, equal places, a null key, keys over several partitions
    for key, size in ((1, 400), (2, 5), (None, 90), (3, 60), (4, 1), (5, 25)):
        for day in chance.choices(range(90), k=size):
            amount = None if chance.random() < 0.1 else D(chance.randrange(-5, 60))
            values.append((key, day, amount, "x"))
    df = rows("k int, d int, a decimal(14,2), _part string", *values)
    history = {}
    for key, day, amount, _ in values:
        history.setdefault(key, []).append((day, amount or 0))
    expected = {(k, presents([a for _, a in sorted(h)], 100, 10)) for k, h in history.items()}
    got = accumulators.reset_accumulator(df, "k", ["d"], "a", "100", keep_zero=True, parts=parts)
    assert {tuple(r) for r in got.collect()} == expected and got.count() == len(expected)
    some = accumulators.reset_accumulator(df, "k", ["d"], "a", "100", parts=parts)
    assert {tuple(r) for r in some.collect()} == {row for row in expected if row[1] > 0}


@pytest.mark.parametrize("low", [0, -9])
@pytest.mark.parametrize("goal", [-3, 0, 1, 40])
def test_next_place_that_is_higher(low, goal):
    chance = random.Random(goal)
    sums = accumulators._running(np.array([chance.randrange(low, 12) for _ in range(200)]))
    wanted = [next((k for k in range(i + 1, 201) if sums[k] - sums[i] >= goal), 201) for i in range(201)]
    assert accumulators._next_reached(sums, goal).tolist() == wanted


@pytest.mark.parametrize("limit", ["1000000", "-1", "100.005"])
def test_accumulator_of_a_key_over_all_partitions(rows, limit):
    # a large limit: the open sum passes through whole partitions
    chance = random.Random(8)
    values = [("k", n, D(chance.randrange(10_000))) for n in range(3000)] + [("z", 1, D(5))]
    got = accumulators.reset_accumulator(
        rows("k string, n int, a decimal(14,2)", *values), "k", ["n"], "a", limit, cap=50, keep_zero=True, parts=9
    )
    goal = D(limit).quantize(D("0.01"), ROUND_HALF_UP)
    assert as_set(got) == [("k", presents([a for _, _, a in values[:-1]], goal, 50)), ("z", int(goal <= 5))]


def test_rows_are_moved_once(rows, monkeypatch):
    plans = []
    stored = accumulators.freeze
    monkeypatch.setattr(accumulators, "freeze", lambda df, label: plans.append(df) or stored(df, label))
    df = rows("k int, n int, a decimal(14,2)", *[(k % 3, k, D(1)) for k in range(50)])
    got = accumulators.reset_accumulator(df, "k", ["n"], "a", "5", parts=3)
    (written,) = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert written.count("Exchange rangepartitioning") == 1 and written.count("Exchange") == 1
    # what follows reads counts and the figures of the edges
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_limit_reached_exactly_and_excess_lost(rows):
    df = rows(
        "k int, n int, a decimal(14,2)",
        (1, 1, D(60)), (1, 2, D(40)), (1, 3, D(99)), (2, 1, D(250)), (2, 2, D(49)), (2, 3, D(50)),
    )
    got = accumulators.reset_accumulator(df, "k", ["n"], "a", "100", keep_zero=True)
    assert as_set(got) == [(1, 1), (2, 1)]


def test_cooldown_day_ten_is_passed_over_and_eleven_counts(rows):
    first = dt.date(2001, 1, 1)

    def day(n):
        return first + dt.timedelta(days=n)

    df = rows(
        "k int, d date, a decimal(14,2)",
        (1, first, D(60)), (1, first, D(50)), (1, day(10), D(500)), (1, day(11), D(99)),
        (2, first, D(100)), (2, day(11), D(100)), (2, day(12), D(100)), (3, first, D(1)),
    )
    got = accumulators.reset_accumulator_cooldown(df, "k", "d", "a", "100")
    assert as_set(got) == [
        (1, 1, D(99), first), (2, 2, D(0), day(11)), (3, 0, D(1), dt.date(1900, 1, 1)),
    ]


def test_known_totals(spark):
    orders = Roles(spark, "/root/testdata/sf0.01").customer_orders
    plain = accumulators.reset_accumulator(
        orders, "customer_id", ["order_date", "order_id"], "amount", "1000000", keep_zero=True
    )
    rested = accumulators.reset_accumulator_cooldown(
        orders, "customer_id", "order_date", "amount", "500000"
    )
    for df, known in ((plain, (2694, 1500, 5)), (rested, (5049, 1500, 9))):
        assert tuple(df.agg(F.sum("presents"), F.count("*"), F.max("presents")).first()) == known


# --- copies and changes that can be restarted -------------------------------------


def test_copy_restarts_without_loss_or_repeats(spark, rows):
    source = rows("k int, v string", *[(k, str(k)) for k in range(20)])
    root = scratch_path(spark, "copy")
    copy_jobs.resumable_copy(source.where("k < 8"), root, "k")
    # an interrupted run: data without the commit marker
    rows("k int, v string", (8, "half")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{root}/run-000001-stopped")
    assert copy_jobs.resumable_copy(source, root, "k").count() == 20
    assert as_set(copy_jobs.resumable_copy(source, root, "k")) == as_set(source)


def test_rows_without_a_key_are_copied_once(spark, rows):
    source = rows("k int, v string", *[(k, str(k)) for k in range(6)], (None, "a"), (None, "b"))
    root = scratch_path(spark, "copy")
    part = copy_jobs.resumable_copy(source.where("k < 3 OR k IS NULL"), root, "k")
    assert part.count() == 5
    for _ in range(2):
        copied = copy_jobs.resumable_copy(source, root, "k")
        assert sorted(map(tuple, copied.collect()), key=repr) == sorted(map(tuple, source.collect()), key=repr)
    alone = scratch_path(spark, "copy")
    for _ in range(2):
        assert copy_jobs.resumable_copy(source.where("k IS NULL"), alone, "k").count() == 2


def test_rows_without_a_key_get_the_price_change_once(spark, rows):
    source = rows("k int, p decimal(14,4)", *[(k, D(10)) for k in (1, 2, 3, None, None)])
    change = ("k", "p", D("1.2"), scratch_path(spark, "reprice"), "rise")
    part = copy_jobs.reprice_once(source, *change, upto=1)
    assert as_set(part.groupBy("p").count()) == [(D("10.0000"), 2), (D("12.0000"), 3)]
    for _ in range(2):
        assert as_set(copy_jobs.reprice_once(source, *change).groupBy("p").count()) == [(D("12.0000"), 5)]


def test_price_changes_once_however_often_restarted(spark, rows):
    source = rows("k int, p decimal(14,4)", *[(k // 2, D(10)) for k in range(20)])
    root = scratch_path(spark, "reprice")
    change = ("k", "p", D("1.2"), root, "rise")
    part = copy_jobs.reprice_once(source, *change, upto=4)
    assert part.where("p = 12").count() == 10 and part.count() == 20
    for _ in range(2):
        done = copy_jobs.reprice_once(source, *change)
        assert [r["p"] for r in done.collect()] == [D(12)] * 20
    later = copy_jobs.reprice_once(done, "k", "p", D("1.2"), root, "second rise")
    assert {r["p"] for r in later.collect()} == {D("14.4")}


def test_fill_from_first_unset_key(rows):
    df = rows("k int, f string", (1, "a"), (2, ""), (3, "c"))
    assert as_set(copy_jobs.fill_unset(df, "k", "f", F.lit("x"))) == [(1, "a"), (2, "x"), (3, "x")]
    once = copy_jobs.fill_unset(df, "k", "f", F.lit("x"))
    assert as_set(copy_jobs.fill_unset(once, "k", "f", F.lit("y"))) == as_set(once)
    assert as_set(copy_jobs.fill_unset(df, "k", "f", F.lit("x"), resume=False))[0] == (1, "x")


def test_purge_keeps_undated_rows_and_can_be_repeated(rows):
    day = dt.date(2001, 1, 1)
    df = rows("k int, d date", (1, day), (2, day - dt.timedelta(days=1)), (3, None))
    kept = copy_jobs.purge_before(df, "d", day)
    assert [r["k"] for r in kept.orderBy("k").collect()] == [1, 3]
    assert as_set(copy_jobs.purge_before(kept, "d", day).select("k")) == [(1,), (3,)]


# --- loading ----------------------------------------------------------------------


@pytest.mark.parametrize(("zero", "totals"), [(True, [(1, D("100")), (2, D("5"))]),
                                              (False, [(1, D("100")), (2, None)])])
def test_order_total(rows, zero, totals):
    headers = rows(
        "order_id int, discount decimal(4,2), freight decimal(14,2)",
        (1, D("0.05"), D(5)), (2, D(0), D(5)), (3, D(0), D(5)),
    )
    details = rows(
        "order_id int, quantity decimal(10,2), unit_price decimal(14,2)",
        (1, D(2), D(50)), (1, None, D(9)), (2, None, D(9)),
    )
    df = loading.order_total(headers, details, null_as_zero=zero).select("order_id", "total")
    assert sorted(map(tuple, df.collect()), key=lambda r: r[0]) == totals


def load(rows, headers, details):
    return loading.load_with_quarantine(
        rows("order_id int, customer_id int, amount string", *headers),
        rows("order_id int, part_id int", *details),
        rows("order_id int", (9,)),
        {"bad amount": F.col("amount").try_cast("decimal(10,2)").isNull()},
        {"no part": F.col("part_id").isNull()},
        {"unknown customer": ("customer_id", rows("c int", (1,)), "c")},
        {"unknown part": ("part_id", rows("p int", (1,)), "p")},
    )


def test_one_bad_line_rejects_the_whole_order(rows):
    headers = [(1, 1, "1"), (2, 1, "1"), (3, 7, "x"), (4, 1, "1"), (4, 1, "1"), (9, 1, "1"), (6, 1, "1")]
    details = [(1, 1), (1, 1), (2, 1), (2, 5), (3, 1), (3, None), (4, 1), (9, 1), (77, 5)]
    good = load(rows, headers, details)
    assert as_set(good.headers) == [(1, 1, "1")]
    assert as_set(good.details) == [(1, 1), (1, 1)]
    assert as_set(good.rejects) == [
        (2, "unknown part"), (3, "bad amount; no part; unknown customer"),
        (4, "duplicate order"), (9, "already loaded"),
    ]


def test_an_order_without_a_key_is_rejected(rows):
    good = load(rows, [(None, 1, "1"), (None, 1, "x"), (1, 1, "1")], [(None, 1), (1, 1)])
    assert as_set(good.headers) == [(1, 1, "1")] and as_set(good.details) == [(1, 1)]
    assert [tuple(r) for r in good.rejects.collect()] == [(None, "bad amount; duplicate order; no order key")]


def test_orders_are_checked_once_for_all_results(rows):
    """Messages of either side, null keys and keys of one side only; no result checks the import anew."""
    headers = [(1, 1, "1"), (2, 1, "x"), (2, 1, "1"), (9, 1, "1"), (9, 1, "1"), (5, None, "1"), (6, 1, "1")]
    details = [(1, 1), (2, 5), (5, 1), (5, 1), (8, 7), (8, None), (None, 5), (9, 1)]
    good = load(rows, headers, details)
    assert sorted(map(tuple, good.headers.collect()), key=repr) == [(1, 1, "1"), (5, None, "1")]
    assert as_set(good.details) == [(1, 1), (5, 1), (5, 1)]
    assert as_set(good.rejects) == [
        (2, "bad amount; duplicate order; unknown part"), (9, "already loaded; duplicate order"),
    ]
    for df in good:
        assert "LeftAnti" not in df._jdf.queryExecution().executedPlan().toString()


def test_loading_then_unloading_gives_the_old_table(rows):
    good = load(rows, [(1, 1, "1")], [(1, 1)])
    target = rows("order_id int", (8,)).unionByName(good.headers.select("order_id"))
    assert as_set(loading.unload_batch(target, good.headers, "order_id")) == [(8,)]


def test_retype_counts_what_does_not_fit(rows):
    df = rows("a int, b string", (1, "2001-01-01"), (40_000, "x"), (None, None))
    retyped, problems = loading.retype_table(df, {"a": "smallint", "b": "date"}, ["a"])
    assert as_set(problems) == [("a: does not fit", 1), ("a: is null", 1), ("b: does not fit", 1)]
    with pytest.raises(Exception, match="OVERFLOW|INVALID_INPUT"):
        retyped.collect()
    assert retyped.limit(1).dtypes == [("a", "smallint"), ("b", "date")]


def test_upsert_guard_keeps_matched_rows(rows):
    target = rows("k int, n int", (1, 5), (2, 0), (3, 7))
    source = rows("k int, n int", (1, 1), (2, 1), (4, 9))
    df = loading.upsert(
        target, source, "k", F.col("t.n") > 0,
        {"n": F.col("t.n") + F.col("s.n")}, {"k": F.col("s.k"), "n": F.col("s.n")},
    )
    assert as_set(df) == [(1, 6), (2, 0), (3, 7), (4, 9)]


def test_check_keys(rows):
    df = rows("a int, b int", (1, 1), (1, 1), (2, 1), (3, 8), (4, None))
    got = loading.check_keys(df, ["a", "b"], {"b": (rows("x int", (1,)), "x")})
    assert as_set(got) == [("foreign key b", "8", 1), ("primary key", "1,1", 2)]
