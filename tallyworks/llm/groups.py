"""Rows of sorted Arrow batches taken group by group inside a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def _changes(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    change = np.zeros(batch.num_rows, bool)
    for name in names:
        values = batch.column(name).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def whole_groups(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of complete groups with the places where groups begin, and the end.

    The rows come sorted by ``names`` (columns of numbers without nulls). No more is held than
    one batch and one group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:
            same = np.ones(batch.num_rows, bool)
            for name in names:
                same &= batch.column(name).to_numpy() == held[-1].column(name)[-1].as_py()
            split = batch.num_rows if same.all() else int(same.argmin())
            held.append(batch.slice(0, split))
            batch = batch.slice(split)
            if not batch.num_rows:
                continue
            group = _joined(held)
            yield group, [0, group.num_rows]
        cuts = _changes(batch, names)
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield batch.slice(0, last), [0, *cuts.tolist()]
        held = [batch.slice(last)]
    if held:
        group = _joined(held)
        yield group, [0, group.num_rows]


