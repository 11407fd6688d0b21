"""Runs a query on Spark and its SQL on DuckDB and compares rows, columns and kinds of value."""

from __future__ import annotations

import atexit
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    # one local session: a folder of its own will do
    shared = tempfile.TemporaryDirectory(prefix="comparing-")
    atexit.register(shared.cleanup)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.checkpoint.dir", shared.name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


def difference(spark: SparkSession, con, run, sql: str, folder: str) -> str | None:
    """None when both give the same rows, else a short description."""
    df = run(spark, folder)
    left = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(sql)
    right = _sorted_rows([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows against {len(right[1])}"
    for ours, theirs in zip(left[1], right[1]):
        if ours != theirs or [type(v) for v in ours] != [type(v) for v in theirs]:
            return f"{dict(zip(left[0], ours))} against {theirs}"
    return None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry

    spark, con = session(), database(folder)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            problem = difference(spark, con, run, entry.oracle_sql()[name], folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - began:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
