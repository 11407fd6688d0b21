"""Stored tables that change, several under one pointer.

A store is a folder with data files, written once and never changed, and a row of numbered
version records, each naming the files that make up every table. Readers see the newest record.
A change writes new files, then moves its record into place under the next number; the move fails
if that number is taken. Until then nobody sees the change, from then on all of it, in all tables
of the store at once. A change that stops leaves files no record names.

Only files with rows to be changed are written anew. They are found by a scan of the columns that
the condition names, which Parquet's own statistics cut short; rewriting is a map over those files.

A job has a name, and its notes are part of the record that its data are in: how far it has come,
which folders it has written. So a restarted job goes on where it stopped, and one that has
finished does nothing, however often it is started.

A table may change its columns' types without being written anew: its files keep the columns they
were written with, and are read with casts until they are rewritten. Columns declared NOT NULL are
checked whenever rows are written; a null stops the write.

A record lists all files of a store, as does any reader of a folder of Parquet files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyworks.sources.storage import file_system

Rewrite = Callable[[DataFrame], DataFrame]


def _schema(entry: dict) -> StructType:
    return StructType.fromJson(json.loads(entry["schema"]))


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema])


class Conflict(RuntimeError):
    """Another change has taken the version that this one was about to become."""


@dataclass
class Change:
    """What one commit will add to and take from the tables of a store."""

    store: TableStore
    record: dict
    job: str
    notes: dict = field(default_factory=dict)
    folders: list[str] = field(default_factory=list)

    def _write(self, df: DataFrame) -> list[str]:
        folder = uuid.uuid4().hex
        df.write.parquet(f"{self.store.root}/data/{folder}")
        self.folders.append(folder)
        return self.store.list_data(folder)

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Add rows and return them as stored.

        The first rows of a table give it its columns; later ones must have the same.
        """
        entry = self.record["tables"].setdefault(table, {"schema": _nullable(df.schema).json(), "files": [], "older": []})
        written = self._write(self._fitted(table, df))
        entry["files"] = [*entry["files"], *written]
        return self.store.read_entry({**entry, "files": written, "older": []})

    def replace(self, table: str, df: DataFrame) -> None:
        """Give the table other rows and columns. ``df`` may read the table's earlier version."""
        self.record["tables"][table] = {"schema": _nullable(df.schema).json(), "files": self._write(df), "older": []}

    def move(self, source: str, target: str) -> None:
        """Let ``target`` hold the files of ``source``, which is empty from then on. No data move."""
        moved = self.record["tables"][source]
        self.record["tables"][target] = moved
        self.record["tables"][source] = {"schema": moved["schema"], "files": [], "older": []}

    def rewrite(self, table: str, files: list[str], rewritten: Rewrite) -> None:
        """Put ``rewritten`` rows in the place of those in ``files``."""
        entry, taken = self.record["tables"][table], set(files)
        written = self._write(self._fitted(table, rewritten(self.store.read_entry(entry, taken))))
        left = [{**old, "files": [name for name in old["files"] if name not in taken]} for old in entry["older"]]
        entry["older"] = [old for old in left if old["files"]]
        entry["files"] = [*[name for name in entry["files"] if name not in taken], *written]

    def retype(self, table: str, types: Mapping[str, str], not_null: Sequence[str] = ()) -> None:
        """Give columns other types and declare some NOT NULL. The files stay; see ``read_entry``."""
        entry = self.record["tables"][table]
        fields = []
        for f in self._schema(table):
            kind = StructType.fromDDL(f"x {types[f.name]}")["x"].dataType if f.name in types else f.dataType
            fields.append(StructField(f.name, kind, f.nullable and f.name not in not_null))
        if entry["files"]:
            entry["older"] = [*entry["older"], {"schema": entry["schema"], "files": entry["files"]}]
        self.record["tables"][table] = {**entry, "schema": StructType(fields).json(), "files": []}

    def _schema(self, table: str) -> StructType:
        return _schema(self.record["tables"][table])

    def _fitted(self, table: str, df: DataFrame) -> DataFrame:
        if table not in self.record["tables"]:
            return df
        fields = list(self._schema(table))
        if set(df.columns) != {f.name for f in fields}:
            raise ValueError(f"{table} has the columns {[f.name for f in fields]}, not {df.columns}")
        columns = []
        for f in fields:
            value = F.col(f"`{f.name}`").cast(f.dataType)
            if not f.nullable:
                value = F.coalesce(value, F.raise_error(F.lit(f"{table}.{f.name} must not be null")).cast(f.dataType))
            columns.append(value.alias(f.name))
        return df.select(*columns)


class TableStore:
    """The tables of one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- reading ----------------------------------------------------------------

    def versions(self) -> list[int]:
        target, system = file_system(self.spark, f"{self.root}/versions")
        if not system.exists(target):
            return []
        names = [status.getPath().getName() for status in system.listStatus(target)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json"))

    def record(self, version: int | None = None) -> dict:
        """The files of all tables and the notes of all jobs, in a version or the newest one."""
        if version is None:
            versions = self.versions()
            if not versions:
                return {"version": 0, "tables": {}, "jobs": {}}
            version = versions[-1]
        target, system = file_system(self.spark, self._record_path(version))
        stream = system.open(target)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of a version; later changes do not show in the frame."""
        return self.read_entry(self.record(version)["tables"][table])

    def read_entry(self, entry: dict, only: set[str] | None = None, with_file: bool = False) -> DataFrame:
        """The rows of a table's files, or of some: files written under other types are cast to the table's.

        ``with_file`` adds ``_file``, the file that a row is in.
        """
        schema = _schema(entry)
        frames = []
        for group in [entry, *entry["older"]]:
            files = [name for name in group["files"] if only is None or name in only]
            if files:
                paths = [f"{self.root}/data/{name}" for name in files]
                df = self.spark.read.schema(_nullable(_schema(group))).parquet(*paths)
                place = F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -2, 2), "/")
                columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]
                frames.append(df.select(*columns, *([place.alias("_file")] if with_file else [])))
        if not frames:
            names = StructType([*_nullable(schema).fields, *([StructField("_file", StringType())] if with_file else [])])
            return self.spark.createDataFrame([], names)
        return reduce(DataFrame.unionByName, frames)

    def notes(self, job: str) -> dict:
        """What a job has noted in its last commit; nothing if it has none."""
        return self.record()["jobs"].get(job, {})

    def list_data(self, folder: str) -> list[str]:
        target, system = file_system(self.spark, f"{self.root}/data/{folder}")
        names = [status.getPath().getName() for status in system.listStatus(target)]
        return sorted(f"{folder}/{name}" for name in names if name.endswith(".parquet"))

    def affected(self, table: str, where: Column | None = None, keys: tuple[str, DataFrame] | None = None) -> list[str]:
        """Files with rows for which ``where`` holds, or whose key column has one of ``keys``, in order of name."""
        rows = self.read_entry(self.record()["tables"][table], with_file=True)
        if where is not None:
            rows = rows.where(where)
        if keys is not None:
            column, values = keys
            # bounds of the keys, so that whole files are passed over by their statistics
            low, high = values.agg(F.min(column), F.max(column)).first()
            if low is None:
                return []
            rows = rows.where(F.col(column).between(low, high)).join(values.select(column), column, "left_semi")
        return sorted(row["_file"] for row in rows.select("_file").distinct().collect())

    # --- changing ---------------------------------------------------------------

    @contextmanager
    def change(self, job: str) -> Iterator[Change]:
        """Collect changes and commit them together; an error inside commits nothing."""
        change = Change(self, self.record(), job)
        change.notes = dict(change.record["jobs"].get(job, {}))
        yield change
        wrote = [*change.notes.get("wrote", []), *change.folders]
        change.record["jobs"][job] = {**change.notes, "wrote": wrote}
        self._commit(change.record)

    def rewrite_in_steps(
        self, table: str, job: str, where: Column | None, rewritten: Rewrite, files_per_step: int | None = None, **notes
    ) -> int:
        """Rewrite the files with rows for which ``where`` holds, some at a time, each file once per job.

        Without ``where`` they are the files still kept under other types.

        Each step commits its files together with the job's notes. Returns the steps taken now:
        none where the job has finished before.
        """
        if self.notes(job).get("finished"):
            return 0
        wrote = set(self.notes(job).get("wrote", []))
        if where is None:
            files = sorted(name for old in self.record()["tables"][table]["older"] for name in old["files"])
        else:
            files = [name for name in self.affected(table, where) if name.split("/")[0] not in wrote]
        size = files_per_step or max(len(files), 1)
        steps = [files[at : at + size] for at in range(0, len(files), size)]
        for number, some in enumerate(steps or [[]]):
            with self.change(job) as change:
                if some:
                    change.rewrite(table, some, rewritten)
                change.notes |= {**notes, "finished": number >= len(steps) - 1}
        return len(steps)

    def _record_path(self, version: int) -> str:
        return f"{self.root}/versions/{version:012d}.json"

    def _commit(self, record: dict) -> None:
        version = record["version"] + 1
        text = json.dumps({**record, "version": version})
        jvm = self.spark.sparkContext._jvm
        source, system = file_system(self.spark, f"{self.root}/versions/{uuid.uuid4().hex}.tmp")
        system.mkdirs(source.getParent())
        stream = system.create(source, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target, _ = file_system(self.spark, self._record_path(version))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            source.toUri() if source.isAbsoluteAndSchemeAuthorityNull() else system.getUri(),
            self.spark.sparkContext._jsc.hadoopConfiguration(),
        )
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(system.makeQualified(source), system.makeQualified(target), options)
        except Py4JJavaError as error:
            system.delete(source, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise Conflict(f"version {version} of {self.root} exists") from None
            raise

    def remove_unused(self, keep_versions: int = 1) -> int:
        """Delete data folders that none of the last versions reads, and older records.

        Not for use while a change or a reader of an older version is at work.
        """
        versions = self.versions()
        used = {
            name.split("/")[0]
            for version in versions[-keep_versions:]
            for entry in self.record(version)["tables"].values()
            for group in [entry, *entry["older"]]
            for name in group["files"]
        }
        target, system = file_system(self.spark, f"{self.root}/data")
        removed = 0
        for status in system.listStatus(target) if system.exists(target) else []:
            if status.getPath().getName() not in used:
                removed += system.delete(status.getPath(), True)
        for version in versions[:-keep_versions]:
            system.delete(file_system(self.spark, self._record_path(version))[0], False)
        return removed
