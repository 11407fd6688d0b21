from __future__ import annotations

import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyworks.operators.gate import readiness_gate
from tallyworks.plans.bindings import AS_OF, Roles
from tallyworks.plans.queries import risk_report
from tallyworks.plans.risk import run_scoring
from tallyworks.sources import sinks, storage

FOLDER = "/root/testdata/sf0.001"


def test_scoring_run_publishes_and_exports_once_a_month(spark, rows):
    roles = Roles(spark, FOLDER)
    report_path, export_path = (storage.scratch_path(spark, name) for name in ("report", "export"))
    before = dt.date(2001, 7, 15)
    published = rows("report_date date", (before,))

    def checks(loaded_on):
        target = rows("input_date date", (loaded_on,))
        return readiness_gate(roles.ledger_all, roles.portfolio, target, published, AS_OF)

    frozen = set(storage.list_folders(spark, storage.shared_folder(spark)))
    assert run_scoring(risk_report(roles), checks(before), report_path, export_path) == "run"
    left = set(storage.list_folders(spark, storage.shared_folder(spark))) - frozen
    assert {path.rsplit("/", 1)[1].split("-")[0] for path in left} == {"report", "export"}
    report, export = spark.read.parquet(report_path), spark.read.parquet(export_path)
    assert report.count() == export.count() > 0
    assert [r["rn"] for r in export.orderBy(F.col("client_id").desc()).collect()] == list(
        range(1, export.count() + 1)
    )
    again = run_scoring(risk_report(roles), checks(AS_OF), report_path, export_path)
    assert again == "already done"
    assert spark.read.parquet(report_path).count() == report.count()
    # stopped after publishing and started again: the month is published once
    n = report.count()
    assert run_scoring(risk_report(roles), checks(before), report_path, export_path) == "run"
    assert spark.read.parquet(report_path).count() == n


def test_a_job_drops_only_its_own_tables(spark):
    outside = storage.freeze(spark.range(2))
    with storage.frozen_job(spark):
        inner = storage.freeze(spark.range(3))
        assert inner.count() == 3
    assert outside.count() == 2
    with pytest.raises(Exception, match="(?i)not.*exist|does not exist|FILE_NOT_EXIST"):
        spark.read.schema(inner.schema).parquet(*inner.inputFiles()).count()


def test_replace_and_partitioned_append(spark, rows):
    path, parts = storage.scratch_path(spark, "replace"), storage.scratch_path(spark, "parts")
    for values in ([(1, "a"), (2, "b")], [(3, "c")]):
        sinks.replace_rows(rows("k int, v string", *values), path)
        sinks.append_rows(rows("k int, v string", *values), parts, "v")
    assert as_set(spark.read.parquet(path)) == [(3, "c")]
    assert as_set(spark.read.parquet(parts).select("k")) == [(1,), (2,), (3,)]
    assert [p.rsplit("/", 1)[1] for p in storage.list_folders(spark, parts)] == ["v=a", "v=b", "v=c"]


def test_frozen_table_does_not_change_and_can_be_dropped(spark):
    frozen = storage.freeze(spark.range(5).withColumn("r", F.rand()))
    assert as_set(frozen) == as_set(frozen)
    assert storage.drop_frozen(spark) >= 1 and storage.drop_frozen(spark) == 0
