"""Writers and readers of publications, and the writers of exports."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources.storage import list_folders

PUBLISHED = "published_on"


def append_rows(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Add rows to a stored table, one folder per value of ``partition_by``."""
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def replace_rows(df: DataFrame, path: str) -> None:
    """Empty a stored table and load ``df``. ``df`` must not read ``path``."""
    df.write.mode("overwrite").parquet(path)


def publish_rows(df: DataFrame, path: str, day: dt.date) -> None:
    """Put ``df`` in place as the publication of ``day``.

    Every day is a folder of its own; only the day's folder is replaced, so a job that is
    started again publishes once. A day without rows leaves no folder.
    """
    (
        df.withColumn(PUBLISHED, F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PUBLISHED)
        .parquet(path)
    )


def published_days(spark: SparkSession, path: str) -> list[dt.date]:
    """Days that have a publication, from the names of the folders alone."""
    mark = f"{PUBLISHED}="
    names = [unquote(folder.rsplit("/", 1)[1]) for folder in list_folders(spark, path)]
    return sorted(dt.date.fromisoformat(name[len(mark):]) for name in names if name.startswith(mark))


def read_publication(spark: SparkSession, path: str, day: dt.date | None = None) -> DataFrame:
    """The rows published on ``day``, or last; no other day's files are opened."""
    if day is None:
        day = published_days(spark, path)[-1]
    return spark.read.parquet(path).where(F.col(PUBLISHED) == F.lit(day)).drop(PUBLISHED)


def replace_remote(
    df: DataFrame, url: str, table: str, batch_rows: int = 1000, **options: str
) -> None:
    """Empty a database table and load ``df`` in statements of ``batch_rows`` rows.

    ``truncate`` keeps the table's definition and grants; every partition
    opens its own connection, so repartition ``df`` to what the database bears.
    """
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(url=url, dbtable=table, batchsize=str(batch_rows), truncate="true", **options)
        .save()
    )
