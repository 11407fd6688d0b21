"""Near copies by an LSH forest over MinHash signatures.

Documents with equal shingle sets form one class. Each class's signature is laid out in
several orders ("trees"), each a tuple of eight hash values; a tree is sorted, and
classes that follow each other with a long enough common prefix are candidates. Links
are confirmed on full shingle sets and joined to components. Then each region of a tree
(classes with a common prefix) is looked at again: it is made deeper while it is
crowded, and classes of one region that are not yet connected are compared too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.components import components
from tallyworks.llm.groups import whole_groups
from tallyworks.llm.scratch import Scratch
from tallyworks.llm.words import distinct_per_row, mix, parts, shingle_hashes, word_hashes

DEPTH = 8


@dataclass(frozen=True)
class ForestSettings:
    """Shape of the forest.

    A pair of similarity s shares ``first_depth`` values in some tree with probability
    1 - (1 - s**first_depth) ** trees: all but one in a million at 0.85.
    """

    shingle: int = 5
    percent: int = 85  # linked when 100 * shared >= percent * united
    trees: int = 24
    first_depth: int = 5
    crowded: int = 8  # classes from which a region is made deeper
    slack: float = 0.13  # pairs whose estimated similarity is lower than the bound by more (five deviations) are not checked
    ids_sent: int = 2_000_000  # doc_ids of candidates (8 bytes each) up to which they are sent to all tasks
    block_rows: int = 256  # classes of one region, and bytes of their sets, in one block;
    block_bytes: int = 4 << 20  # a task compares two blocks at a time


def _factors(trees: int) -> np.ndarray:
    return mix(np.arange(1, trees * DEPTH + 1, dtype=np.uint64)) | np.uint64(1)


def _signatures(values: np.ndarray, sizes: np.ndarray, trees: int) -> np.ndarray:
    """16-bit MinHash values, one row of trees * 8 for each non-empty set."""
    factors = _factors(trees)
    sizes = sizes[sizes > 0]
    out = np.zeros((len(sizes), len(factors)), np.uint16)
    row = at = 0
    while row < len(sizes):
        end = row + 1
        total = int(sizes[row])
        while end < len(sizes) and total + sizes[end] <= 1 << 15:
            total += int(sizes[end])
            end += 1
        own = values[at : at + total]
        firsts = np.cumsum(sizes[row:end]) - sizes[row:end]
        for k, factor in enumerate(factors):
            out[row:end, k] = mix(np.minimum.reduceat(own * factor, firsts)) >> np.uint64(48)
        row, at = end, at + total
    return out


def _profiles(settings: ForestSettings, with_sets: bool):
    """Task function: number of shingles, hash of the set and signature (or the set) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text", 1 << 20):
                words, counts = word_hashes(batch.column("text"))
                values, sizes = distinct_per_row(*shingle_hashes(words, counts, settings.shingle))
                if with_sets:
                    offsets = np.concatenate([[0], np.cumsum(sizes)])
                    raw = [values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), pa.array(raw, pa.binary()), pa.array(8 * sizes)], ["id", "shingles", "bytes"]
                    )
                    continue
                ends = np.concatenate([[0], np.cumsum(sizes)])
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(s)))]) for s in (1, 2)]
                keys = [(c[ends[1:]] - c[ends[:-1]]).view(np.int64) for c in sums]
                signs: list[bytes | None] = [None] * len(sizes)
                rows = _signatures(values, sizes, settings.trees)
                for k, row in enumerate(np.flatnonzero(sizes)):
                    signs[row] = rows[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes), pa.array(keys[0]), pa.array(keys[1]), pa.array(signs, pa.binary())],
                    ["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    return run


def _tree_rows(settings: ForestSettings):
    """Task function: the row of each class in every tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2")
            # big-endian halves, so that numbers sort as the tuples do
            halves = signs.reshape(len(ids), settings.trees, 2, 4).astype(">u2").view(">u8")[..., 0].astype(np.uint64)
            for tree in range(settings.trees):
                high, low = halves[:, tree, 0], halves[:, tree, 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), tree, np.int32)),
                        pa.array(high.view(np.int64)),
                        pa.array(low.view(np.int64)),
                        pa.array(ids),
                    ],
                    ["tree", "high", "low", "id"],
                )

    return run


def _common(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the next."""
    out = np.zeros(max(len(high) - 1, 0), np.int64)
    same = np.ones(len(out), bool)
    for half in (high, low):
        differ = half[1:] ^ half[:-1]
        for shift in (48, 32, 16, 0):
            same &= (differ >> np.uint64(shift)) & np.uint64(0xFFFF) == 0
            out += same
    return out


def _neighbours(settings: ForestSettings):
    """Task function over sorted trees: adjacent candidates, and members of regions of three or more.

    Rows are (a, b, null) for a pair and (id, null, region) for a member.
    """

    def regions(depth, rows, common, keys, out):
        """Split ``rows`` where fewer than ``depth`` values are shared; go on where crowded."""
        cut = np.flatnonzero(common[rows[0] : rows[1] - 1] < depth) + rows[0] + 1
        for begin, end in zip([rows[0], *cut], [*cut, rows[1]]):
            if end - begin < 3:
                continue
            if end - begin > settings.crowded and depth < DEPTH:
                regions(depth + 1, (begin, end), common, keys, out)
            else:
                out.append((begin, end, keys(begin, depth)))

    def block(tree, high, low, ids):
        common = np.where(tree[1:] == tree[:-1], _common(high, low), 0)
        near = np.flatnonzero((common >= settings.first_depth) & (ids[1:] != ids[:-1]))
        a, b = np.minimum(ids[near], ids[near + 1]), np.maximum(ids[near], ids[near + 1])

        def key(at, depth):
            masks = [~np.uint64(0) << np.uint64(16 * max(0, 4 - d)) if d > 0 else np.uint64(0) for d in (depth, depth - 4)]
            parts_of = [np.uint64(int(tree[at]) * 16 + depth), high[at] & masks[0], low[at] & masks[1]]
            h = np.zeros(1, np.uint64)
            for value in parts_of:
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + value)
            return int(h.view(np.int64)[0])

        found: list = []
        regions(settings.first_depth, (0, len(ids)), common, key, found)
        members = [ids[begin:end] for begin, end, _ in found]
        names = [np.full(end - begin, name, np.int64) for begin, end, name in found]
        members = np.concatenate(members) if members else np.zeros(0, np.int64)
        names = np.concatenate(names) if names else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([a, members])),
                pa.concat_arrays([pa.array(b), pa.nulls(len(members), pa.int64())]),
                pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(names)]),
            ],
            ["a", "b", "region"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in range(4)]
            columns[1:3] = [c.view(np.uint64) for c in columns[1:3]]
            held = columns if held is None else [np.concatenate(x) for x in zip(held, columns)]
            if len(held[0]) < 20_000:
                continue
            # up to the last place where a region ends; a very large one is taken as it is, its
            # last row again with what follows: its members name the same region either way
            common = np.where(held[0][1:] == held[0][:-1], _common(held[1], held[2]), 0)
            ends = np.flatnonzero(common < settings.first_depth) + 1
            if len(ends):
                yield from block(*[c[: ends[-1]] for c in held])
                held = [c[ends[-1] :] for c in held]
            elif len(held[0]) >= 200_000:
                yield from block(*held)
                held = [c[-1:] for c in held]
        if held is not None:
            yield from block(*held)

    return run


def _confirmed(settings: ForestSettings):
    """Task function: pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_numpy() for k in (0, 1))
            keep = np.zeros(len(a), bool)
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep[k] = 100 * shared >= settings.percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return run


def _promising(settings: ForestSettings):
    """Task function: pairs whose signatures agree often enough."""
    least = (settings.percent / 100 - settings.slack) * settings.trees * DEPTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(batch.num_rows, -1) for k in (2, 3)
            )
            keep = pa.array((x == y).sum(1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["a", "b"])

    return run


def _shared(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of membership tables."""
    values = np.concatenate(sets)
    order = np.argsort(values)
    values = values[order]
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    # values of one set only are shared with none
    several = ~(first & np.concatenate([first[1:], [True]]))
    owner, column = owner[several], (np.cumsum(first[several]) - 1).astype(np.int32)
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        begin, end = np.searchsorted(column, [at, at + columns])
        holds = np.zeros((len(sets), columns), np.float32)
        holds[owner[begin:end], column[begin:end] - at] = 1
        out += holds @ holds.T
    return out.astype(np.int64)


def _roots(near: np.ndarray) -> np.ndarray:
    """Smallest place connected with each place of a symmetric table of links."""
    x, y = np.nonzero(near)
    root = np.arange(len(near))
    while True:
        new = root.copy()
        np.minimum.at(new, x, root[y])
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _regional(settings: ForestSettings):
    """Task function over members sorted by region: links of each group of members.

    All pairs of a group are compared on their full sets; what goes out is one row for each
    member that is connected with an earlier one, never the pairs.
    """

    def links(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        ids = rows.column("id").to_numpy()
        sets = [np.frombuffer(v.as_py(), np.uint64) for v in rows.column("shingles")]
        sizes = np.array([len(s) for s in sets])
        shared = _shared(sets)
        near = 100 * shared >= settings.percent * (sizes[:, None] + sizes - shared)
        first = ids[_roots(near)]
        moved = first != ids
        return first[moved], ids[moved]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, cuts in whole_groups(batches, ("region", "low", "high")):
            for begin, end in zip(cuts, cuts[1:]):
                if end - begin > 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in links(batch.slice(begin, end - begin))], ["a", "b"])

    return run


def _with_both(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    left = table.select(F.col("id").alias("a"), F.col(value).alias("x"))
    right = table.select(F.col("id").alias("b"), F.col(value).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def near_copies(docs: DataFrame, settings: ForestSettings = ForestSettings()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document.

    ``docs`` has doc_id and text, other columns are not read. Documents without words (null
    or empty texts) have no shingles and link with nothing. A null doc_id is given back with
    its size, links with nothing and is its own component (null), kept. Equal texts and
    repeated rows are one class; all rows of the smallest doc_id are kept. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "forest")
    profiles = scratch.keep(
        docs.select("doc_id", "text").mapInArrow(
            _profiles(settings, False), "doc_id long, n_shingles long, set_a long, set_b long, signature binary"
        ),
        "profiles",
    )
    linked = profiles.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # the smallest doc_id stands for its class
    classes = scratch.keep(
        linked.groupBy("set_a", "set_b")
        .agg(F.min(F.struct(F.col("doc_id").alias("id"), "signature")).alias("first"))
        .select("set_a", "set_b", "first.*"),
        "classes",
    )
    signs = classes.select("id", "signature")

    trees = signs.mapInArrow(_tree_rows(settings), "tree int, high long, low long, id long")
    found = scratch.keep(
        trees.repartition("tree", "high")
        .sortWithinPartitions("tree", F.col("high"), "low", "id")
        .mapInArrow(_neighbours(settings), "a long, b long, region long"),
        "neighbours",
    )
    pairs = found.where("b IS NOT NULL").select("a", "b").distinct()
    pairs = scratch.keep(_with_both(pairs, signs, "signature").mapInArrow(_promising(settings), "a long, b long"), "pairs")
    members = found.where("b IS NULL").select(F.col("a").alias("id"), "region")

    involved = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(members.select("id")).distinct()
    involved = scratch.keep(involved, "involved")
    # few ids go to the texts; beyond the checked number both sides are shuffled
    few = involved.count() <= settings.ids_sent
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(involved) if few else involved, "id", "left_semi")
    texts = texts.dropDuplicates(["id"])
    sets = scratch.keep(
        texts.mapInArrow(_profiles(settings, True), "id long, shingles binary, bytes long"), "sets"
    )
    links = scratch.keep(_with_both(pairs, sets, "shingles").mapInArrow(_confirmed(settings), "a long, b long"), "links")
    joined = components(links, scratch)

    # classes of one region that the neighbours have not connected
    placed = members.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
        "region", "id", F.coalesce("component_id", "id").alias("group")
    )
    placed = scratch.keep(placed.distinct().join(sets.select("id", "bytes"), "id"), "placed")
    mixed = placed.groupBy("region").agg(
        F.min("group").alias("x"), F.max("group").alias("y"), F.count("*").alias("n"), F.sum("bytes").alias("bytes")
    )
    blocks = F.ceil(F.greatest(F.col("n") / settings.block_rows, F.col("bytes") / settings.block_bytes)).cast("int")
    mixed = mixed.where("x < y").select("region", blocks.alias("blocks"))
    # a crowded region is compared in pairs of blocks, each a group of its own
    open_rows = (
        placed.join(mixed, "region")
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
        .select("region", "low", "high", "id")
    )
    keys = ("region", "low", "high")
    rest = (
        open_rows.join(sets.select("id", "shingles"), "id")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "id")
        .mapInArrow(_regional(settings), "a long, b long")
    )
    more = scratch.keep(rest.distinct(), "more-links")
    if not more.isEmpty():
        joined = components(links.union(more), scratch)
    scratch.drop(found, pairs, sets, placed)

    owners = classes.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
        "set_a", "set_b", F.coalesce("component_id", "id").alias("component_id")
    )
    kind = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return (
        profiles.select("doc_id", "n_shingles", *[F.when(kind, F.col(c)).otherwise(F.xxhash64("doc_id")).alias(c) for c in ("set_a", "set_b")])
        .join(owners, ["set_a", "set_b"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
