"""The package reaches Python workers that cannot import it by themselves."""

from __future__ import annotations

import os
import subprocess
import sys
import zipfile

from conftest import ROOT

from tallyworks.sources.shipping import package_zip

FOREIGN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "3").config("spark.checkpoint.dir", {shared!r}).getOrCreate())
from tallyworks.operators.accumulators import reset_accumulator
from tallyworks.operators.key_ranges import key_range_batches
from tallyworks.operators.numbering import number_rows
df = spark.range(60).selectExpr("id % 3 AS k", "id AS v")
assert number_rows(df, ["v"], within=["k"]).agg(F.max("rn")).first()[0] == 20
assert reset_accumulator(df, "k", ["v"], "v", "100").count() == 3
assert key_range_batches(df, "v", 7).count() == 9
print("shipped")
"""


def test_workers_in_a_foreign_folder(tmp_path):
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = FOREIGN.format(root=ROOT, shared=str(tmp_path / "shared"))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("shipped"), done.stderr[-2000:]


def test_the_zip_holds_every_module(tmp_path):
    names = zipfile.ZipFile(package_zip(str(tmp_path))).namelist()
    assert "tallyworks/__init__.py" in names and "tallyworks/operators/numbering.py" in names
    assert all(name.endswith(".py") for name in names)
