"""Links between vectors of high cosine, by spherical-cap filters.

A filter direction is a sum of one codeword for each block of coordinates (a random
product code after a random rotation). Every vector is list-decoded to all directions
whose cap it reaches: those within ``margin`` of its best one. Vectors of one label that
share a direction are verified; a pair counts where it meets first.
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


@dataclass(frozen=True)
class CapSettings:
    """Code and caps."""

    cosine: float = 0.98
    blocks: int = 3
    words: int = 24  # codewords of a block: words ** blocks directions
    margin: float = 0.06
    block_rows: int = 512  # members of one direction that one task compares at a time
    seed: int = 11


class _Code:
    def __init__(self, width: int, settings: CapSettings):
        rng = np.random.default_rng([settings.seed, width])
        self.rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
        self.books = []
        for block in np.array_split(np.arange(width), min(settings.blocks, width)):
            book = rng.normal(size=(settings.words, len(block)))
            book /= np.linalg.norm(book, axis=1, keepdims=True) * np.sqrt(settings.blocks)
            self.books.append((block, book))
        self.words, self.margin = settings.words, settings.margin

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of every direction that a row of ``unit`` reaches, in order of rows.

        Partial sums that cannot come within the margin of the best sum are dropped block by block.
        """
        turned = unit @ self.rotation
        scores = [turned[:, block] @ book.T for block, book in self.books]
        short = [scores[0].max(1, keepdims=True) - scores[0]]
        short += [s.max(1, keepdims=True) - s for s in scores[1:]]
        rows, words = np.nonzero(short[0] <= self.margin)
        lost = short[0][rows, words]
        for part in short[1:]:
            total = lost[:, None] + part[rows]
            at, word = np.nonzero(total <= self.margin)
            lost, words, rows = total[at, word], words[at] * self.words + word, rows[at]
        return rows, words


def _decoded(settings: CapSettings):
    """Task function: a row for each vector and direction, with all directions of the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, _Code] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sizes = np.array([len(v) for v in batch.column("vector")])
                for width in np.unique(sizes):
                    some = batch.filter(pa.array(sizes == width))
                    flat = some.column("vector").flatten().to_numpy().astype(np.float64)
                    x = flat.reshape(-1, width)
                    unit = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    code = codes.setdefault(int(width), _Code(int(width), settings))
                    rows, directions = code.decode(unit)
                    cuts = np.searchsorted(rows, np.arange(len(x) + 1))
                    lists = [np.sort(directions[a:b]).astype("<i8").tobytes() for a, b in zip(cuts, cuts[1:])]
                    raw = [v.astype("<f8").tobytes() for v in unit]
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("label").take(take),
                            pa.array(np.full(len(rows), width, np.int32)),
                            pa.array(directions.astype(np.int64)),
                            some.column("id").take(take),
                            some.column("copies").take(take),
                            pa.array(raw, pa.binary()).take(take),
                            pa.array(lists, pa.binary()).take(take),
                        ],
                        ["label", "width", "direction", "id", "copies", "unit", "directions"],
                    )

    return run


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Smallest place connected with each place."""
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root


def _met_before(lists: list[np.ndarray], direction: int, columns: int = 2048) -> np.ndarray:
    """Which pairs of members share a direction smaller than ``direction``."""
    cut = [own[: np.searchsorted(own, direction)] for own in lists]
    owner = np.repeat(np.arange(len(cut)), [len(own) for own in cut])
    names, place = np.unique(np.concatenate(cut), return_inverse=True)
    met = np.zeros((len(cut), len(cut)), bool)
    for at in range(0, len(names), columns):
        here = (place >= at) & (place < at + columns)
        holds = np.zeros((len(cut), min(columns, len(names) - at)), np.float32)
        holds[owner[here], place[here] - at] = 1
        met |= holds @ holds.T > 0
    return met


def _compare(rows: pa.RecordBatch, settings: CapSettings, direction: int, cross: bool):
    """Links of one group: how many each member has, and a forest of them."""
    unit = np.frombuffer(b"".join(rows.column("unit").to_pylist()), "<f8").reshape(rows.num_rows, -1)
    ids, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
    lists = [np.frombuffer(v, "<i8") for v in rows.column("directions").to_pylist()]
    side = rows.column("side").to_numpy()
    near = unit @ unit.T >= settings.cosine
    x, y = np.nonzero(np.triu(near, 1))
    if cross:
        differ = side[x] != side[y]
        x, y = x[differ], y[differ]
    if len(x):
        members, place = np.unique(np.concatenate([x, y]), return_inverse=True)
        met = _met_before([lists[k] for k in members], direction)
        first = ~met[place[: len(x)], place[len(x) :]]
        x, y = x[first], y[first]
    links = np.bincount(x, copies[y], len(ids)) + np.bincount(y, copies[x], len(ids))
    root = _forest(x, y, len(ids))
    return ids, links.astype(np.int64), ids[root]


def _verified(settings: CapSettings):
    """Task function over rows sorted by group: (id, links, id connected with)."""
    group = ("label", "width", "direction", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, cuts in whole_groups(batches, group):
            direction, low, high = (batch.column(name).to_numpy() for name in group[2:])
            out: list[list[np.ndarray]] = [[], [], []]
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    found = _compare(batch.slice(a, b - a), settings, int(direction[a]), low[a] != high[a])
                    keep = found[1] > 0
                    for held, values in zip(out, found):
                        held.append(values[keep])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out], ["id", "links", "near"])

    return run


def vector_links(vectors: DataFrame, settings: CapSettings = CapSettings()) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label).

    Only vectors of equal, non-null labels and equal widths link. A vector that is null, empty or
    zero, or has a null or non-finite component, links with nothing and is its own component;
    so does one without a vec_id, which is kept. Equal vectors are one class and count each
    other; other columns are not read, and no rows give no rows.

    A direction that many vectors reach is compared in pairs of blocks; every pair of blocks is a
    group of its own, so no task holds more than two blocks at once.
    """
    scratch = Scratch(vectors.sparkSession, "caps")
    fit = F.coalesce(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.forall("embedding", lambda v: F.coalesce((v.cast("double") - v.cast("double")) == 0, F.lit(False)))
        & F.exists("embedding", lambda v: v != 0),
        F.lit(False),
    )
    rows = vectors.select("vec_id", "label", "embedding", fit.alias("fit")).withColumns(
        {
            "set_a": F.when(F.col("fit"), F.xxhash64("label", "embedding")).otherwise(F.xxhash64("vec_id")),
            "set_b": F.when(F.col("fit"), F.xxhash64("embedding", F.lit(1))).otherwise(F.lit(0)),
        }
    )
    classes = scratch.keep(
        rows.where("fit")
        .groupBy("label", "set_a", "set_b")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("embedding").alias("vector")),
        "classes",
    )
    decoded = scratch.keep(
        classes.select(F.col("label").cast("long").alias("label"), "id", "copies", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(
            _decoded(settings),
            "label long, width int, direction long, id long, copies long, unit binary, directions binary",
        ),
        "decoded",
    )
    group = ["label", "width", "direction"]
    crowd = decoded.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1")
    # blocks of a crowded direction: each member meets every block, its own included
    n_blocks = F.ceil(F.col("n") / settings.block_rows).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int")
    placed = (
        decoded.join(crowd, group)
        .withColumn("n_blocks", n_blocks)
        .withColumn("side", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("low", F.least("side", "other"))
        .withColumn("high", F.greatest("side", "other"))
        .drop("n", "n_blocks", "other")
    )
    keys = [*group, "low", "high"]
    found = scratch.keep(
        placed.repartition(*keys).sortWithinPartitions(*keys, "id").mapInArrow(_verified(settings), "id long, links long, near long"),
        "links",
    )
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("near").alias("b")), scratch)
    joined = joined.withColumnRenamed("node", "id")
    owners = (
        classes.drop("vector", "label")
        .join(counts, "id", "left")
        .join(joined, "id", "left")
        .select(
            "set_a",
            "set_b",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    return (
        rows.select("vec_id", "fit", "set_a", "set_b")
        .join(owners, ["set_a", "set_b"], "left")
        .select(
            "vec_id",
            F.when(F.col("fit"), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
            F.when(F.col("fit"), F.coalesce("component_id", "vec_id")).otherwise(F.col("vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
