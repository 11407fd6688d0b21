"""Stored tables: commits, stops between steps, restarts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyworks.operators import stored_jobs
from tallyworks.sources import sinks, stored
from tallyworks.sources.storage import scratch_path

D = Decimal


class Stopped(RuntimeError):
    pass


@pytest.fixture
def store(spark):
    return stored.TableStore(spark, scratch_path(spark, "store"))


def stop_after(monkeypatch, commits):
    """Let ``commits`` commits pass, then stop just before the next one, all data written."""
    real, left = stored.TableStore._commit, [commits]

    def commit(self, record):
        if not left[0]:
            raise Stopped
        left[0] -= 1
        real(self, record)

    monkeypatch.setattr(stored.TableStore, "_commit", commit)


def stopped_and_run_again(monkeypatch, commits, job):
    with monkeypatch.context() as patch:
        stop_after(patch, commits)
        with pytest.raises(Stopped):
            job()
    return job()


def in_files(spark, n, files):
    """n keys in ``files`` files of neighbouring keys."""
    return spark.range(0, n, 1, files).select(
        F.col("id").alias("k"),
        F.date_add(F.lit(dt.date(2001, 1, 1)), F.col("id").cast("int")).alias("d"),
        F.when(F.col("id") % 4 == 0, "").otherwise("set").alias("f"),
        F.lit(10).cast("decimal(14,4)").alias("p"),
    )


# --- the store ------------------------------------------------------------------


def test_readers_keep_their_version_and_see_whole_commits(store, spark):
    with store.change("one") as change:
        change.append("a", spark.range(3))
        change.append("b", spark.range(2))
    old = store.read("a")
    with store.change("two") as change:
        change.append("a", spark.range(3, 5))
        change.replace("b", spark.range(7).withColumn("x", F.lit(1)))
    assert (old.count(), store.read("a").count(), store.read("b").columns) == (3, 5, ["id", "x"])
    assert store.read("b", version=1).count() == 2
    with pytest.raises(Stopped), store.change("three") as change:
        change.append("a", spark.range(9))
        raise Stopped
    assert store.read("a").count() == 5 and store.versions() == [1, 2]


def test_of_two_changes_from_one_version_the_second_fails(store, spark):
    store_again = stored.TableStore(spark, store.root)
    with pytest.raises(stored.Conflict), store.change("slow") as slow:
        with store_again.change("fast") as fast:
            fast.append("a", spark.range(1))
        slow.append("a", spark.range(5))
    assert store.read("a").count() == 1 and store.notes("slow") == {}


def test_columns_are_kept_and_cast(store, rows):
    for job, schema, row in (("one", "a long, b string", (1, "x")), ("two", "b string, a int", ("y", 2))):
        with store.change(job) as change:
            change.append("t", rows(schema, row))
    assert store.read("t").dtypes == [("a", "bigint"), ("b", "string")]
    assert as_set(store.read("t")) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="has the columns"), store.change("three") as change:
        change.append("t", rows("a long", (1,)))


def test_unused_files_go(store, spark, monkeypatch):
    for number in range(3):
        with store.change(str(number)) as change:
            change.replace("a", spark.range(number + 1))
    with monkeypatch.context() as patch:
        stop_after(patch, 0)
        with pytest.raises(Stopped), store.change("lost") as change:
            change.replace("a", spark.range(50))
    assert store.remove_unused() == 3 and store.versions() == [3]
    assert store.read("a").count() == 3


# --- deletes and updates ----------------------------------------------------------


@pytest.mark.parametrize("commits", [0, 1, 2])
def test_purge_goes_on_after_a_stop(store, spark, monkeypatch, commits):
    rows = in_files(spark, 80, 8).unionByName(in_files(spark, 1, 1).withColumn("d", F.lit(None).cast("date")))
    stored_jobs.store_table(store, "t", rows)
    before = set(store.record()["tables"]["t"]["files"])
    cutoff = dt.date(2001, 1, 1) + dt.timedelta(days=35)

    def job():
        return stored_jobs.purge_stored(store, "t", "d", cutoff, "purge", files_per_step=1)

    assert stopped_and_run_again(monkeypatch, commits, job) == 4 - commits
    left = store.read("t")
    assert as_set(left.select("k")) == [(0,), *[(k,) for k in range(35, 80)]]
    # four files held old rows; the others are the very same files
    assert len(before & set(store.record()["tables"]["t"]["files"])) == len(before) - 4
    assert job() == 0


@pytest.mark.parametrize("resume", [True, False])
def test_fill_changes_the_same_rows_when_stopped(store, spark, monkeypatch, resume):
    rows = in_files(spark, 40, 4).withColumn("f", F.when(F.col("k").isin(13, 30), "").otherwise("set"))
    stored_jobs.store_table(store, "t", rows)

    def job():
        return stored_jobs.fill_stored(
            store, "t", "k", "f", F.concat(F.lit("v"), F.col("k")), "fill", resume, files_per_step=1
        )

    assert stopped_and_run_again(monkeypatch, 1, job) == (2 if resume else 3)
    first = 13 if resume else 0
    assert as_set(store.read("t").select("k", "f")) == [
        (k, f"v{k}" if k >= first else "set") for k in range(40)
    ]


def test_fill_without_unset_rows_changes_nothing(store, rows):
    stored_jobs.store_table(store, "t", rows("k int, f string", (1, "a"), (None, "b")))
    assert stored_jobs.fill_stored(store, "t", "k", "f", F.lit("x"), "fill") == 0
    assert store.read("t").count() == 2 and store.notes("fill")["finished"]


@pytest.mark.parametrize("commits", [0, 1, 3])
def test_price_changes_once_though_stopped(store, spark, monkeypatch, commits):
    stored_jobs.store_table(store, "t", in_files(spark, 40, 4))

    def job(name="rise", where=None):
        return stored_jobs.reprice_stored(store, "t", "p", D("1.2"), name, where, files_per_step=1)

    stopped_and_run_again(monkeypatch, commits, job)
    assert job() == 0
    assert store.read("t").select("p").distinct().collect() == [(D(12),)]
    job("second rise", F.col("k") < 5)
    assert as_set(store.read("t").groupBy("p").count()) == [(D("12.0000"), 35), (D("14.4000"), 5)]


def test_unload_takes_rows_from_all_tables_or_none(store, spark, monkeypatch, rows):
    for table in ("headers", "lines"):
        stored_jobs.store_table(store, table, in_files(spark, 40, 4))
    batch = rows("k long, x int", (3, 1), (3, 1), (27, 1), (99, 1), (None, 1))

    def job():
        stored_jobs.unload_stored(store, ["headers", "lines"], batch, "k", "unload")
        return [store.read(table).count() for table in ("headers", "lines")]

    with monkeypatch.context() as patch:
        stop_after(patch, 0)
        with pytest.raises(Stopped):
            job()
    assert [store.read(table).count() for table in ("headers", "lines")] == [40, 40]
    before = set(store.record()["tables"]["lines"]["files"])
    assert job() == [38, 38] and job() == [38, 38]
    assert len(before & set(store.record()["tables"]["lines"]["files"])) == 2


def test_merge_rewrites_only_files_with_its_keys(store, spark, monkeypatch, rows):
    stored_jobs.store_table(store, "t", in_files(spark, 40, 4).select("k", "p"))
    before = set(store.record()["tables"]["t"]["files"])
    source = rows("k long, p int", (12, 5), (15, 50), (100, 7), (None, 8))

    def job():
        stored_jobs.upsert_stored(
            store, "t", source, "k", F.col("s.p") < 20,
            {"p": F.col("t.p") + F.col("s.p")}, {"k": F.col("s.k"), "p": F.col("s.p")}, "merge",
        )

    stopped_and_run_again(monkeypatch, 0, job)
    job()
    changed = store.read("t").where("p <> 10")
    assert sorted(map(tuple, changed.collect()), key=repr) == [(100, D(7)), (12, D(15)), (None, D(8))]
    assert store.read("t").count() == 42
    assert len(before & set(store.record()["tables"]["t"]["files"])) == 3


# --- columns ----------------------------------------------------------------------


@pytest.mark.parametrize("commits", [0, 1, 2])
def test_retyping_part_by_part(store, spark, monkeypatch, commits):
    rows = spark.range(0, 40, 1, 4).select(F.col("id").cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    stored_jobs.store_table(store, "t", rows)

    def job():
        return stored_jobs.retype_stored(store, "t", {"k": "bigint", "v": "decimal(10,2)"}, ["v"], "retype", files_per_step=1)

    with monkeypatch.context() as patch:
        stop_after(patch, commits)
        with pytest.raises(Stopped):
            job()
    # the columns are the new ones as soon as the first commit is made, wherever the files stand
    changed = [("k", "bigint"), ("v", "decimal(10,2)")] if commits else [("k", "int"), ("v", "string")]
    assert store.read("t").dtypes == changed and store.read("t").count() == 40
    if commits:
        with store.change("more") as change:
            change.append("t", spark.range(40, 42).selectExpr("id AS k", "id AS v"))
        stored_jobs.purge_stored(store, "t", "k", 1, "purge")
    job()
    entry = store.record()["tables"]["t"]
    assert not entry["older"] and store.read("t").dtypes == [("k", "bigint"), ("v", "decimal(10,2)")]
    assert as_set(store.read("t")) == [(k, D(k)) for k in (range(1, 42) if commits else range(40))]
    assert job() == 0


def test_a_null_or_a_value_that_does_not_fit_stops_the_change(store, rows):
    stored_jobs.store_table(store, "t", rows("k int, v string", (1, "x"), (2, None)))
    for types, not_null, problem in (({"v": "int"}, [], "v: does not fit"), ({}, ["v"], "v: is null")):
        with pytest.raises(ValueError, match=problem):
            stored_jobs.retype_stored(store, "t", types, not_null, "retype")
    assert store.read("t").dtypes == [("k", "int"), ("v", "string")] and store.versions() == [1]


def test_a_null_stops_the_write_once_declared(store, rows):
    stored_jobs.store_table(store, "t", rows("k int, v string", (1, "x")))
    stored_jobs.retype_stored(store, "t", {}, ["v"], "retype")
    with pytest.raises(Exception, match="t.v must not be null"), store.change("more") as change:
        change.append("t", rows("k int, v string", (2, "y"), (3, None)))
    assert as_set(store.read("t")) == [(1, "x")]
    with pytest.raises(Exception, match="must not be null"):
        stored_jobs.fill_stored(store, "t", "k", "v", F.lit(None).cast("string"), "fill", resume=False)
    with store.change("more") as change:
        change.append("t", rows("k int, v string", (2, "y")))
    assert as_set(store.read("t")) == [(1, "x"), (2, "y")]


# --- loads ----------------------------------------------------------------------


def load(store, rows, job="load", headers=None, lines=None):
    return stored_jobs.load_orders(
        store,
        rows("order_id int, customer_id int, discount decimal(4,2), freight decimal(14,2)", *(headers or [
            (1, 1, D("0.05"), D(5)), (2, 1, D(0), D(5)), (3, 9, D(0), D(5)), (None, 1, D(0), D(0)),
        ])),
        rows("order_id int, part_id int, quantity decimal(10,2), unit_price decimal(14,2)", *(lines or [
            (1, 1, D(2), D(50)), (1, 1, None, D(9)), (2, 7, D(1), D(1)), (3, 1, D(1), D(1)), (None, 1, D(1), D(1)),
        ])),
        job,
        {}, {},
        {"unknown customer": ("customer_id", rows("c int", (1,)), "c")},
        {"unknown part": ("part_id", rows("p int", (1,)), "p")},
    )


def test_headers_and_lines_come_together_or_not_at_all(store, rows, monkeypatch):
    with monkeypatch.context() as patch:
        stop_after(patch, 0)
        with pytest.raises(Stopped):
            load(store, rows)
    assert store.record()["tables"] == {}
    counts = {"order_headers": 1, "order_lines": 2, "order_rejects": 3}
    assert load(store, rows) == counts and load(store, rows) == counts
    header = store.read("order_headers").select("order_id", "total", "status").collect()
    assert header == [(1, D("100.0000"), "N")]
    assert as_set(store.read("order_lines").select("order_id")) == [(1,), (1,)]
    rejects = store.read("order_rejects").select("order_id", "errors")
    assert sorted(map(tuple, rejects.collect()), key=repr) == [
        (2, "unknown part"), (3, "unknown customer"), (None, "no order key"),
    ]
    assert as_set(store.read("load_runs")) == [("load", "done", 1, 2, 3)]


def test_a_later_load_rejects_what_is_there(store, rows):
    load(store, rows)
    again = load(store, rows, "second", [(1, 1, D(0), D(1)), (4, 1, D(0), D(1))], [(1, 1, D(1), D(1)), (4, 1, D(1), D(1))])
    assert again == {"order_headers": 1, "order_lines": 1, "order_rejects": 1}
    assert as_set(store.read("order_headers").select("order_id")) == [(1,), (4,)]
    assert as_set(store.read("order_rejects").where("job = 'second'").select("order_id", "errors")) == [
        (1, "already loaded")
    ]
    stored_jobs.unload_stored(store, ["order_headers", "order_lines"], rows("order_id int", (1,)), "order_id", "undo")
    assert as_set(store.read("order_headers").select("order_id")) == as_set(store.read("order_lines").select("order_id")) == [(4,)]


# --- export and publication --------------------------------------------------------


@pytest.mark.parametrize("commits", [0, 1, 3, 4])
def test_export_replaces_the_one_before_whenever_stopped(store, spark, monkeypatch, commits):
    first = stored_jobs.export_in_slices(store, "export", spark.range(7), ["id"], "first", 3)
    assert as_set(first) == [(0, 2), (1, 3), (2, 2)]

    def job():
        # rows in another order each time: the numbering of the first start counts
        return stored_jobs.export_in_slices(
            store, "export", spark.range(100, 110).orderBy(F.rand()), ["id"], "second", 4, slices_per_step=1
        )

    with monkeypatch.context() as patch:
        stop_after(patch, commits)
        with pytest.raises(Stopped):
            job()
    assert store.read("export").count() == 7
    for _ in range(2):
        assert as_set(job()) == [(0, 3), (1, 4), (2, 3)]
        assert as_set(store.read("export")) == [(100 + n, n + 1) for n in range(10)]
    assert store.read("export aside").isEmpty() and store.read("export numbered").isEmpty()


def test_export_with_missing_rows_keeps_the_old_one(store, spark, monkeypatch):
    stored_jobs.export_in_slices(store, "export", spark.range(7), ["id"], "first", 3)
    append = stored.Change.append
    monkeypatch.setattr(stored.Change, "append", lambda self, table, df: append(self, table, df.where("id <> 4")))
    with pytest.raises(RuntimeError, match="differs"):
        stored_jobs.export_in_slices(store, "export", spark.range(9), ["id"], "second", 3)
    assert store.read("export").count() == 7


def test_export_steps_read_their_own_rows(store, spark, monkeypatch):
    """Each step's filter is a range of numbers that Parquet's statistics can cut short."""
    append, plans = stored.Change.append, []

    def noted(self, table, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return append(self, table, df)

    monkeypatch.setattr(stored.Change, "append", noted)
    stored_jobs.export_in_slices(store, "export", spark.range(25), ["id"], "first", 4, slices_per_step=2)
    assert as_set(store.read("export")) == [(n, n + 1) for n in range(25)]
    assert len(plans) == 4
    for step, plan in enumerate(plans):
        assert f"GreaterThanOrEqual(rn,{8 * step})" in plan and f"LessThanOrEqual(rn,{8 * step + 7})" in plan


def test_export_of_no_rows(store, spark):
    stored_jobs.export_in_slices(store, "export", spark.range(3), ["id"], "first", 3)
    assert stored_jobs.export_in_slices(store, "export", spark.range(0), ["id"], "second", 3).collect() == []
    assert store.read("export").collect() == []


def test_a_day_published_again_replaces_itself_alone(spark):
    path, days = scratch_path(spark, "published"), [dt.date(2001, 7, 31), dt.date(2001, 8, 31)]
    for day, n in ((days[0], 4), (days[1], 2), (days[1], 3)):
        sinks.publish_rows(spark.range(n), path, day)
    assert sinks.published_days(spark, path) == days
    assert sinks.read_publication(spark, path).count() == 3
    assert sinks.read_publication(spark, path, days[0]).count() == 4
    plan = sinks.read_publication(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(published_on" in plan and "2001-08-31" in plan
