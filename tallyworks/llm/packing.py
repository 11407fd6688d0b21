"""Harmonic packing of token sequences.

Every document is encoded and cut into pieces of at most ``capacity`` ids. A piece of
length n belongs to class ``capacity // n`` = j, for lengths in (capacity/(j+1),
capacity/j], and a sequence of class j takes exactly j pieces: pieces need no look at
each other, and each task fills sequences of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyworks.sources.shipping import ship

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_TASK_BITS = 33


def cut_lengths(n: int, capacity: int = 1024, cuts: int = 3, slack: int = 8) -> list[int]:
    """Lengths of a document's pieces.

    Whole sequences first. The rest is cut at the slot sizes ``capacity // j``, at most
    ``cuts`` times; it stays whole once its own slot has no more than ``slack`` ids to spare.
    """
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    for _ in range(cuts):
        if not rest or capacity // (capacity // rest) - rest <= slack:
            break
        slot = capacity // -(-capacity // rest)
        lengths.append(slot)
        rest -= slot
    return lengths + [rest] if rest else lengths


class _Bins:
    """Open sequences of one task, by class."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, piece: tuple) -> None:
        kind = self.capacity // piece[2]
        held = self.open.setdefault(kind, [])
        held.append(piece)
        if len(held) == kind:
            self._close(self.open.pop(kind))

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.rows.append((*piece[:5], self.next_id, offset, *piece[5:]))
            offset += piece[2]
        self.next_id += 1

    def finish(self) -> None:
        """The task's unfilled sequences share what room is left, longest pieces first."""
        rest = sorted((p for held in self.open.values() for p in held), key=lambda p: (-p[2], str(p[:2])))
        self.open.clear()
        room: list[int] = []
        filled: list[list[tuple]] = []
        for piece in rest:
            for at, left in enumerate(room):
                if left >= piece[2]:
                    break
            else:
                at = len(room)
                room.append(self.capacity)
                filled.append([])
            room[at] -= piece[2]
            filled[at].append(piece)
        for pieces in filled:
            self._close(pieces)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 0,
    cuts: int = 3,
    slack: int = 8,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity`` ids.

    ``docs`` has doc_id and text (other columns are not read). A null text is empty: its
    only id is ``end_id``, which ends every document. A null doc_id stays null. Repeated
    rows are packed as often as they occur; no rows give no sequences. ``with_ids`` adds
    the ids of each piece as little-endian 32-bit values.

    Tasks pack on their own: a sequence never holds pieces of two tasks, and a repeated
    task gives the same sequences, since its rows are sorted first.
    """
    ship(docs.sparkSession)
    schema = SCHEMA + (", ids binary" if with_ids else "")
    names = [part.split()[0] for part in schema.split(",")]
    types = [pa.binary() if name == "ids" else pa.int64() for name in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyworks.llm.token_ids import word_memory
        from tallyworks.llm.words import parts

        memory = word_memory(tokenizer)
        bins = _Bins(capacity, TaskContext.get().partitionId() << _TASK_BITS)
        end = int(end_id).to_bytes(4, "little")

        def flush() -> pa.RecordBatch:
            columns = list(zip(*bins.rows)) or [()] * len(names)
            bins.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for whole in batches:
            for batch in parts(whole, "text"):
                texts = batch.column("text")
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), memory.ids(texts)):
                    ids += end
                    total, start = len(ids) // 4, 0
                    for length in cut_lengths(total, capacity, cuts, slack):
                        piece = ids[4 * start : 4 * (start + length)]
                        row = (doc_id, start, length, zlib.crc32(piece), total)
                        bins.add(row + (piece,) if with_ids else row)
                        start += length
                yield flush()
        bins.finish()
        yield flush()

    ordered = docs.select("doc_id", "text").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, schema)
