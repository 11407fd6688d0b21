"""Words of whole texts as 64-bit hashes, for a batch of rows at a time.

A word is a run of bytes other than the ASCII white space 0x09-0x0D and 0x20, with
A-Z made lower case. All work is on numpy arrays over the bytes of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLOCK_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> _U(30))) * _MIX[0]
    h = (h ^ (h >> _U(27))) * _MIX[1]
    return h ^ (h >> _U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, nulls as empty, and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least."""
    sizes = text_bytes(batch.column(column))[1]
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(sizes, sizes[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def _hash_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; ``data`` has 8 spare bytes at its end."""
    blocks = np.lib.stride_tricks.as_strided(
        data.view(np.uint8), shape=(max(len(data) - 7, 0), 8), strides=(1, 1)
    )
    out = lengths.astype(np.uint64) * _ODD
    active = np.arange(len(starts))
    at, left = starts.copy(), lengths.copy()
    while len(active):
        block = np.ascontiguousarray(blocks[at]).view("<u8").ravel()
        block = block & _BLOCK_MASK[np.minimum(left, 8)]
        out[active] = mix((out[active] ^ block) * _ODD + _U(1))
        more = left > 8
        active, at, left = active[more], at[more] + 8, left[more] - 8
    return out


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each row."""
    raw, offsets = text_bytes(column)
    rows = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    data = np.zeros(len(raw) + 8, np.uint8)
    np.take(_LOWER, raw, out=data[:-8])
    solid = ~_SPACE[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = solid[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(raw)]
    before[edges] = False  # words do not run on from one row into the next
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = solid[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    hashes = _hash_words(data, starts, ends - starts)
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = 5):
    """Hashes of each row's runs of ``size`` words, not made distinct, and their counts.

    A row with fewer words has its whole sequence as one shingle, a row without words none.
    """
    ends = np.cumsum(counts)
    firsts = ends - counts
    if len(words) >= size:
        runs = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            runs = mix(runs * _ODD + words[k : k + len(runs)])
    else:
        runs = np.zeros(0, np.uint64)
    per_row = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    inside = np.repeat(firsts, per_row) + _ramp(per_row)
    out = np.zeros(len(inside), np.uint64)
    full = np.repeat(counts >= size, per_row)
    out[full] = runs[inside[full]]
    at = np.cumsum(per_row) - per_row
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        h = np.full(1, counts[row], np.uint64)
        for k in range(firsts[row], ends[row]):
            h = mix(h * _ODD + words[k : k + 1])
        out[at[row]] = h[0]
    return out, per_row


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count c, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def distinct_per_row(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and how many there are."""
    out, sizes, at = [], np.zeros(len(counts), np.int64), 0
    for row, n in enumerate(counts):
        if n:
            own = np.unique(values[at : at + n])
            out.append(own)
            sizes[row] = len(own)
        at += n
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes
