"""Token ids in binary files with Elias-Fano document boundaries.

A shard is two files: ``.ids`` holds the ids of its documents one after the other, 16 or
32 bits each; ``.idx`` holds where each document begins and its doc_id, both as
Elias-Fano sequences: the low bits of the values packed, the high bits in unary, with the
place of every 256th value kept so that one value is found without reading the rest.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.sources.shipping import ship

MAGIC = b"TWEF0001"
STEP = 256
MANIFEST = "shard long, name string, n_docs long, n_tokens long"


class EliasFano:
    """A non-decreasing sequence of numbers >= 0 in about 2 + log2(largest / n) bits each."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, np.int64))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        places = (values >> low_bits) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1, np.uint8)
        unary[places] = 1
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        high = np.packbits(unary, bitorder="little").tobytes()
        return cls(n, low_bits, low, high, places[::STEP].copy())

    def _lows(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.int64)
        begin, end = first * self.low_bits, (first + count) * self.low_bits
        part = np.frombuffer(self.low, np.uint8)[begin // 8 : -(-end // 8)]
        bits = np.unpackbits(part, bitorder="little")[begin % 8 :][: end - begin]
        return bits.reshape(count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def block(self, at: int) -> np.ndarray:
        """Values ``STEP * at`` onwards, up to STEP of them."""
        first = at * STEP
        count = min(STEP, self.n - first)
        begin = int(self.samples[at])
        end = int(self.samples[at + 1]) if at + 1 < len(self.samples) else 8 * len(self.high)
        part = np.frombuffer(self.high, np.uint8)[begin // 8 : -(-end // 8)]
        ones = np.flatnonzero(np.unpackbits(part, bitorder="little")) + begin // 8 * 8
        ones = ones[ones >= begin][:count]
        return ((ones - np.arange(first, first + count)) << self.low_bits) + self._lows(first, count)

    def select(self, i: int) -> int:
        """Value number ``i``, by way of its block only."""
        return int(self.block(i // STEP)[i % STEP])

    def values(self) -> np.ndarray:
        blocks = [self.block(at) for at in range(len(self.samples))]
        return np.concatenate(blocks) if blocks else np.zeros(0, np.int64)

    def sections(self) -> tuple[dict, list[bytes]]:
        body = [self.low, self.high, self.samples.astype("<i8").tobytes()]
        return {"n": self.n, "low_bits": self.low_bits, "sizes": [len(b) for b in body]}, body

    @classmethod
    def decode(cls, head: dict, data: memoryview) -> tuple[EliasFano, memoryview]:
        a, b, c = head["sizes"]
        low, high = bytes(data[:a]), bytes(data[a : a + b])
        samples = np.frombuffer(data[a + b : a + b + c], "<i8")
        return cls(head["n"], head["low_bits"], low, high, samples), data[a + b + c :]


def index_bytes(ends: np.ndarray, doc_ids: list[int | None], width: int) -> bytes:
    """The ``.idx`` file: boundaries (0 first) and doc_ids, which ascend with nulls first."""
    given = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(given[0]) if len(given) else 0
    bounds, bound_body = EliasFano.encode(np.concatenate([[0], ends])).sections()
    ids, id_body = EliasFano.encode(given - base).sections()
    head = json.dumps(
        {"width": width, "nulls": len(doc_ids) - len(given), "base": base, "bounds": bounds, "ids": ids}
    ).encode()
    return b"".join([MAGIC, len(head).to_bytes(8, "little"), head, *bound_body, *id_body])


def read_index(data: bytes) -> tuple[EliasFano, list[int | None], int]:
    """Boundaries, doc_ids and the bytes of one id, from an ``.idx`` file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token index")
    size = int.from_bytes(data[8:16], "little")
    head = json.loads(data[16 : 16 + size])
    bounds, rest = EliasFano.decode(head["bounds"], memoryview(data)[16 + size :])
    ids, _ = EliasFano.decode(head["ids"], rest)
    return bounds, [None] * head["nulls"] + (ids.values() + head["base"]).tolist(), head["width"]


def _system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Encode all texts and write them to ``folder`` in ascending doc_id order.

    Returns the manifest (shard, name, n_docs, n_tokens) of the files. ``docs`` has doc_id
    and text; a null text is empty, null doc_ids come first, and equal doc_ids follow the
    order of their texts' hashes. An attempt writes under a name of its own, and only the files of
    finished attempts are in the manifest, so repeated tasks do no harm. ``folder`` must be
    one that every executor reaches.
    """

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyworks.llm.token_ids import word_memory
        from tallyworks.llm.words import parts

        memory = word_memory(tokenizer)
        width = 2 if memory.vocabulary <= 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex[:12]}"
        end = int(end_id).to_bytes(4, "little")
        system, root = _system(folder)
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        out = None
        for whole in batches:
            for batch in parts(whole, "text"):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}.ids")
                encoded = [ids + end for ids in memory.ids(batch.column("text"))]
                doc_ids += batch.column("doc_id").to_pylist()
                lengths += [len(ids) // 4 for ids in encoded]
                out.write(np.frombuffer(b"".join(encoded), "<u4").astype(f"<u{width}").tobytes())
        if out is not None:
            out.close()
            ends = np.cumsum(np.array(lengths, np.int64))
            with system.open_output_stream(f"{root}/{name}.idx") as index:
                index.write(index_bytes(ends, doc_ids, width))
            row = {"shard": [shard], "name": [name], "n_docs": [len(lengths)], "n_tokens": [int(ends[-1])]}
            yield pa.RecordBatch.from_pydict(row)

    # bounds are sampled to the driver: numbers only, no texts; equal doc_ids are dealt by hash
    by_id = F.col("doc_id").asc_nulls_first()
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(by_id, F.xxhash64("text"))
        .sortWithinPartitions(by_id, F.xxhash64("text"), "text")
    )
    return ordered.mapInArrow(run, MANIFEST)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document read back from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. ``with_ids`` adds the ids as an array.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    # one row per shard: the window sees as many rows as there are files
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(folder)
        for row in (row for batch in batches for row in batch.to_pylist()):
            with system.open_input_stream(f"{root}/{row['name']}.idx") as index:
                bounds, doc_ids, width = read_index(index.read())
            places = bounds.values()
            with system.open_input_stream(f"{root}/{row['name']}.ids") as data:
                for at in range(0, len(doc_ids), 2000):
                    columns: list[list] = [[], [], [], [], []]
                    for k in range(at, min(at + 2000, len(doc_ids))):
                        n = int(places[k + 1] - places[k])
                        ids = np.frombuffer(data.read(n * width), f"<u{width}").astype("<u4")
                        crc = zlib.crc32(ids.tobytes())
                        values = (doc_ids[k], row["first"] + int(places[k]), len(ids), crc, ids.tolist() if with_ids else None)
                        for column, value in zip(columns, values):
                            column.append(value)
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
                    if with_ids:
                        names.append("ids")
                        arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(arrays, names)

    # a number of its own keeps small rows, each a whole file to read, from being put in one task
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return shards.select("name", "first").repartition(tasks, "name").mapInArrow(run, schema)
