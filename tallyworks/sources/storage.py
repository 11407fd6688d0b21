"""Tables the jobs read and write.

A job that must see the same rows twice (numbering, restartable rounds) writes
them to the shared folder named by ``spark.checkpoint.dir`` and reads them back:
the lineage is cut and a lost executor cannot change what was written.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tallyworks.sources.shipping import ship

_LOCAL_FOLDERS: dict[str, str] = {}
_FROZEN: list[str] = []
_JOB: ContextVar[list[str] | None] = ContextVar("frozen_by_job", default=None)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remote_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Pass-through read: the database runs ``query`` and Spark sees its result, over one connection.

    For results that fit one task; ``remote_ranges`` and ``remote_slices`` read large ones.
    """
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def remote_ranges(
    spark: SparkSession, url: str, query: str, column: str, low, high, parts: int, **options: str
) -> DataFrame:
    """The same over ``parts`` connections, each with a range of a numeric, date or timestamp column.

    ``low`` and ``high`` only decide where the ranges are cut: rows outside and rows without a
    value are read too. They come from ``remote_bounds`` or from what is known of the table.
    """
    chosen = range_options(url, query, column, low, high, parts)
    return spark.read.format("jdbc").options(**chosen, **options).load()


def range_options(url: str, query: str, column: str, low, high, parts: int) -> dict[str, str]:
    if parts < 1 or low > high:
        raise ValueError(f"no ranges from {low} to {high} in {parts} parts")
    return {
        "url": url,
        "dbtable": f"({query}) q",
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }


def remote_bounds(spark: SparkSession, url: str, query: str, column: str, **options: str) -> tuple:
    """Lowest and highest value of a column of ``query``, worked out by the database."""
    bounds = f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM ({query}) q"
    return tuple(remote_query(spark, url, bounds, **options).first())


def remote_slices(
    spark: SparkSession, url: str, query: str, predicates: Sequence[str], properties: Mapping[str, str] | None = None
) -> DataFrame:
    """The same over one connection for each predicate. Together they must choose every row once."""
    if not predicates:
        raise ValueError("no predicates: nothing would be read")
    return spark.read.jdbc(url, f"({query}) q", predicates=list(predicates), properties=dict(properties or {}))


def day_predicates(column: str, days: Sequence[dt.date]) -> list[str]:
    """Predicates that cut a table at ``days`` into half-open ranges: all rows, each once, undated ones first."""
    cuts = sorted(set(days))
    if not cuts:
        return ["1 = 1"]
    mark = [f"DATE '{day.isoformat()}'" for day in cuts]
    first = f"{column} < {mark[0]} OR {column} IS NULL"
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(mark, mark[1:])]
    return [first, *between, f"{column} >= {mark[-1]}"]


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from the session.

    Only a local session without the setting (tests) gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never used twice."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, label: str = "frozen") -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    own = _JOB.get()
    (_FROZEN if own is None else own).append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def frozen_job(spark: SparkSession) -> Iterator[None]:
    """Delete the tables frozen inside the block at its end, and no others.

    For jobs that have written their results by then: frames made inside must not be read afterwards.
    """
    mine: list[str] = []
    outer = _JOB.set(mine)
    try:
        yield
    finally:
        _JOB.reset(outer)
        _drop(spark, mine)


def drop_frozen(spark: SparkSession) -> int:
    """Delete the tables that ``freeze`` wrote in this process outside of any job; for when their results are used up."""
    return _drop(spark, _FROZEN)


def _drop(spark: SparkSession, paths: list[str]) -> int:
    dropped = 0
    while paths:
        target, system = file_system(spark, paths.pop())
        dropped += system.delete(target, True)
    return dropped


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a finished write (the commit marker is there)."""
    return _exists(spark, f"{path}/_SUCCESS")


def file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    target, system = file_system(spark, path)
    return system.exists(target)


def list_folders(spark: SparkSession, root: str) -> list[str]:
    """Sub-folders of ``root`` in name order; none when it does not exist."""
    target, system = file_system(spark, root)
    if not system.exists(target):
        return []
    return sorted(
        status.getPath().toString() for status in system.listStatus(target) if status.isDirectory()
    )
