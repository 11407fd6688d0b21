"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from tallyworks.plans.bindings import Roles
from tallyworks.plans.queries import QUERIES
from tallyworks.sources import storage

FOLDER = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"key_range_batches"}))
def test_plans_stay_in_spark(spark, name):
    shown = plan(QUERIES[name](spark, FOLDER))
    for slow in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct"):
        assert slow not in shown
    assert "BroadcastNestedLoopJoin" not in shown


def test_filter_and_columns_reach_the_scan(spark):
    shown = plan(QUERIES["point_lookup"](spark, FOLDER))
    assert "EqualTo(o_orderpriority,1-URGENT)" in shown
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in shown
    turnover = plan(QUERIES["salary_turnover"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate,2001-02-01" in turnover


@pytest.mark.parametrize(
    ("name", "kind"),
    [("unload_batch", "LeftAnti"), ("deals_without_schedule", "LeftAnti"),
     ("salary_unpivot_avg", "LeftSemi"), ("load_good_details", "LeftSemi")],
)
def test_semi_and_anti_joins(spark, name, kind):
    assert kind in plan(QUERIES[name](spark, FOLDER))


def test_numbering_window_sees_one_row_per_partition(spark):
    shown = plan(QUERIES["assign_batches"](spark, FOLDER))
    # the only window is the offset over partition counts; rows are not moved to one task
    assert shown.count("Window [") == 1
    assert re.search(r"Exchange SinglePartition.*\n.*HashAggregate\(keys=\[_part", shown)


def test_shared_folder_must_be_set_on_a_cluster(spark):
    class Elsewhere:
        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(Elsewhere)
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_every_role_reads_a_given_table(spark):
    roles = Roles(spark, FOLDER)
    for name, member in vars(Roles).items():
        if isinstance(member, property):
            assert "Scan" in plan(getattr(roles, name)) or "FileScan" in plan(getattr(roles, name))
