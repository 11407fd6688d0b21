"""Intermediate tables of one job, kept in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyworks.sources.shipping import ship
from tallyworks.sources.storage import shared_folder


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables that a job stores to cut its lineage; ``drop`` removes those no longer needed.

    With ``shuffles_go`` the shuffle files of a table go as soon as it is stored; Spark keeps
    them else until the driver collects its garbage.
    """

    def __init__(self, spark: SparkSession, label: str, shuffles_go: bool = False):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._count = 0
        self._shuffles_go = shuffles_go
        self._kept: list[DataFrame] = []

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the stored table."""
        path = self.path(name)
        before = self.spark.conf.get(_SHUFFLES_GO, None)
        if self._shuffles_go:
            self.spark.conf.set(_SHUFFLES_GO, "true")
        try:
            df.write.parquet(path)
        finally:
            if self._shuffles_go:
                self.spark.conf.unset(_SHUFFLES_GO) if before is None else self.spark.conf.set(_SHUFFLES_GO, before)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._scratch_path = path
        self._kept.append(stored)
        return stored

    def drop(self, *tables: DataFrame) -> None:
        """Delete stored tables whose readers have all run."""
        for table in tables:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            config = self.spark.sparkContext._jsc.hadoopConfiguration()
            path.getFileSystem(config).delete(path, True)
            self._kept = [kept for kept in self._kept if kept is not table]

    def drop_all_but(self, *wanted: DataFrame) -> None:
        """Delete all stored tables that the results, now stored too, no longer need."""
        self.drop(*[table for table in self._kept if all(table is not keep for keep in wanted)])
