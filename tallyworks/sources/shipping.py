"""Getting this package to the Python workers of a session.

Functions that run inside tasks are found by name, so every worker needs the package. ``ship``
packs it into a zip and gives that to Spark, once for each application; the operators that run
Python inside tasks call it. ``spark-submit --py-files`` with such a zip does the same beforehand.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def package_zip(folder: str) -> str:
    """Write a zip of the package's Python files to ``folder`` and return its path."""
    path = os.path.join(folder, f"{os.path.basename(PACKAGE)}.zip")
    above = os.path.dirname(PACKAGE)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder_path, _, names in os.walk(PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder_path, name)
                    packed.write(file, os.path.relpath(file, above))
    return path


def ship(spark: SparkSession) -> None:
    """Make the package known to the session's Python workers."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED or PACKAGE.endswith(".zip") or ".zip/" in PACKAGE:
        return
    # only the driver reads the zip; Spark hands it to the executors
    context.addPyFile(package_zip(tempfile.mkdtemp(prefix="package-")))
    _SHIPPED.add(context.applicationId)
