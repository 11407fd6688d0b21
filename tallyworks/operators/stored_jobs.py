"""Deletes, updates, merges, loads and exports on stored tables, safe to stop and start again.

Each works on a ``TableStore`` and takes a job name. Steps that are committed stay; a job
started again goes on with the rest, and does nothing once it has finished. A later run of the
same kind needs a new name. Rows that a change does not concern stay in their files untouched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.loading import Loaded, load_with_quarantine, order_total, retype_table, upsert
from tallyworks.operators.numbering import number_rows
from tallyworks.sources.storage import freeze
from tallyworks.sources.stored import TableStore

NEW_ORDER = "N"


def store_table(store: TableStore, table: str, df: DataFrame, key: str | None = None, job: str | None = None) -> None:
    """Load a new table once, in files of narrow key ranges where ``key`` is given."""
    name = job or f"create {table}"
    if store.notes(name).get("finished"):
        return
    laid = df if key is None else df.repartitionByRange(key).sortWithinPartitions(key)
    with store.change(name) as change:
        change.replace(table, laid)
        change.notes["finished"] = True


def purge_stored(
    store: TableStore, table: str, date_col: str, cutoff: dt.date, job: str, files_per_step: int | None = None
) -> int:
    """Delete the rows dated before ``cutoff``, some files at a time; undated rows stay."""
    old = F.col(date_col) < F.lit(cutoff)
    return store.rewrite_in_steps(
        table, job, old, lambda rows: rows.where(~F.coalesce(old, F.lit(False))), files_per_step
    )


def fill_stored(
    store: TableStore, table: str, key: str, col: str, value: Column, job: str,
    resume: bool = True, unset: str = "", files_per_step: int | None = None,
) -> int:
    """Give ``col`` a value in all rows, or from the lowest key whose ``col`` is unset on.

    That key is found by the job's first step and kept, so steps taken later change the same rows.
    """
    if not resume:
        return store.rewrite_in_steps(
            table, job, F.lit(True), lambda rows: rows.withColumn(col, value), files_per_step
        )
    rows = store.read(table)
    start = store.notes(job).get("start")
    if start is None:
        start = rows.where(F.col(col) == unset).agg(F.min(F.col(key)).cast("string")).first()[0]
    kind = rows.schema[key].dataType
    after = F.col(key) >= F.lit(start).cast(kind) if start is not None else F.lit(False)
    return store.rewrite_in_steps(
        table, job, after, lambda some: some.withColumn(col, F.when(after, value).otherwise(F.col(col))),
        files_per_step, start=start,
    )


def reprice_stored(
    store: TableStore, table: str, col: str, factor: Decimal, job: str,
    where: Column | None = None, files_per_step: int | None = None,
) -> int:
    """Multiply ``col`` exactly once in every row, or in those that ``where`` chooses.

    A file's change and the note that it has been made are one commit. ``where`` must not read ``col``.
    """
    chosen = F.lit(True) if where is None else where
    raised = (F.col(col) * F.lit(factor)).cast(store.read(table).schema[col].dataType)
    return store.rewrite_in_steps(
        table, job, chosen, lambda rows: rows.withColumn(col, F.when(chosen, raised).otherwise(F.col(col))),
        files_per_step,
    )


def retype_stored(
    store: TableStore, table: str, types: Mapping[str, str], not_null: Sequence[str], job: str,
    files_per_step: int | None = None,
) -> int:
    """Change column types of a table and declare columns NOT NULL, rewriting its files some at a time.

    Nulls and values that do not fit are counted first; any of them stops the job and the table
    stays as it is. Then the table has its new columns at once: files not yet rewritten are read
    with casts. From then on a null in a NOT NULL column stops whatever would write it.
    """
    if not store.notes(job):
        wrong = retype_table(store.read(table), types, not_null)[1].where("n > 0").collect()
        if wrong:
            raise ValueError(f"{table}: {', '.join(f'{row.problem} ({row.n})' for row in wrong)}")
        with store.change(job) as change:
            change.retype(table, types, not_null)
            change.notes["finished"] = False
    return store.rewrite_in_steps(table, job, None, lambda rows: rows, files_per_step)


def unload_stored(store: TableStore, tables: Sequence[str], batch: DataFrame, key: str, job: str) -> None:
    """Delete the rows whose key is in ``batch`` from all ``tables``, in one commit."""
    if store.notes(job).get("finished"):
        return
    keys = freeze(batch.select(key).where(F.col(key).isNotNull()).distinct(), "batch-keys")
    with store.change(job) as change:
        for table in tables:
            files = store.affected(table, keys=(key, keys))
            if files:
                change.rewrite(table, files, lambda rows: rows.join(keys, key, "left_anti"))
        change.notes["finished"] = True


def upsert_stored(
    store: TableStore, table: str, source: DataFrame, key: str, guard: Column,
    set_exprs: Mapping[str, Column], insert_exprs: Mapping[str, Column], job: str,
) -> None:
    """Merge ``source`` into a table, in one commit; see ``upsert`` for the rules.

    Only files that hold a key of ``source`` are rewritten. Keys that none holds are added with them.
    """
    if store.notes(job).get("finished"):
        return
    source = freeze(source, "merge-source")
    files = store.affected(table, keys=(key, source.select(key).where(F.col(key).isNotNull()).distinct()))
    with store.change(job) as change:
        change.rewrite(table, files, lambda rows: upsert(rows, source, key, guard, set_exprs, insert_exprs))
        change.notes["finished"] = True


def load_orders(
    store: TableStore,
    headers: DataFrame,
    details: DataFrame,
    job: str,
    header_rules: Mapping[str, Column],
    detail_rules: Mapping[str, Column],
    header_refs: Mapping[str, tuple[str, DataFrame, str]],
    detail_refs: Mapping[str, tuple[str, DataFrame, str]],
    key: str = "order_id",
) -> dict:
    """Load the good orders of an import with their lines, total and status, all or nothing.

    ``order_headers``, ``order_lines``, ``order_rejects`` and a row of ``load_runs`` become visible
    in one commit. Orders that the store already has are rejected. A header's total counts a line without
    an amount as zero. Returns the counts of the run; a finished run is not repeated.
    """
    done = store.notes(job)
    if done.get("finished"):
        return done["counts"]
    tables = store.record()["tables"]
    known = store.read("order_headers").select(key) if "order_headers" in tables else headers.select(key).limit(0)
    loaded: Loaded = load_with_quarantine(
        headers, details, known, header_rules, detail_rules, header_refs, detail_refs, key
    )
    with store.change(job) as change:
        # each table is written once; what follows from it is worked out from the rows as stored
        lines = change.append("order_lines", loaded.details)
        # only good orders have lines there, and the total leaves out those without
        totals = order_total(headers, lines, key).withColumn("status", F.lit(NEW_ORDER))
        added = {
            "order_headers": change.append("order_headers", totals),
            "order_lines": lines,
            "order_rejects": change.append("order_rejects", loaded.rejects.withColumn("job", F.lit(job))),
        }
        counts = {table: df.count() for table, df in added.items()}
        run = store.spark.createDataFrame(
            [(job, "done", *counts.values())], "job string, status string, headers long, lines long, rejects long"
        )
        change.append("load_runs", run)
        change.notes |= {"finished": True, "counts": counts}
    return counts


def export_in_slices(
    store: TableStore, table: str, df: DataFrame, order_by: Sequence[str | Column], job: str,
    size: int = 1000, slices_per_step: int = 1000,
) -> DataFrame:
    """Replace the exported ``table`` by ``df``, pushed in slices of ``size`` row numbers.

    The rows are numbered once and stored, so that a job started again goes on with the same
    slices; numbers start at 1, so slice 0 is one row short. Each step adds its slices to a table
    aside and notes the next slice, in one commit. Before the new export takes the old one's
    place, the rows aside are counted against the numbering, slice by slice; a difference stops
    the job and the old export stays. Returns (slice, n_rows) of the export.
    """
    numbered, aside = f"{table} numbered", f"{table} aside"
    slice_no = F.expr(f"rn div {int(size)}")

    def per_slice(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(slice_no.alias("slice")).agg(F.count(F.lit(1)).alias(name))

    if not store.notes(job):
        rows = number_rows(df, order_by, "rn")
        with store.change(job) as change:
            change.replace(numbered, rows)
            change.replace(aside, rows.limit(0))
            change.notes |= {"rows": rows.count(), "next": 0}
    notes = store.notes(job)
    if not notes.get("finished"):
        rows = store.read(numbered)
        for start in range(notes["next"], notes["rows"] // size + 1, slices_per_step):
            with store.change(job) as change:
                # a range of numbers, which lie in few files: steps do not read the whole numbering again
                change.append(aside, rows.where(F.col("rn").between(start * size, (start + slices_per_step) * size - 1)))
                change.notes["next"] = start + slices_per_step
        both = per_slice(rows, "wanted").join(per_slice(store.read(aside), "found"), "slice", "full_outer")
        wrong = both.where(~F.col("wanted").eqNullSafe(F.col("found"))).limit(5).collect()
        if wrong:
            raise RuntimeError(f"{job}: the export differs from its numbering in {wrong}")
        with store.change(job) as change:
            change.move(aside, table)
            change.replace(numbered, rows.limit(0))
            change.notes["finished"] = True
    return per_slice(store.read(table), "n_rows")
