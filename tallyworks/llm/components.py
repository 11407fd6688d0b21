"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.scratch import Scratch

_LINKS = "child long, parent long"


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's links as (node, smallest node reached by them), without the roots."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        nodes, places = np.unique(ends, return_inverse=True)
        a, b = places.reshape(2, -1)
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            new = np.minimum(new, new[new])
            new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        moved = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["child", "parent"]
        )


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component_id) for every node of ``links`` that is not its component's smallest.

    ``links`` has two columns of whole numbers, in any order and with repeats. Each round
    contracts what lies together in a batch, then lets every node hang its larger
    neighbours, and its parents, on the smallest node it sees (large and small stars); the
    rounds grow with the logarithm of the longest path. A node with very many
    neighbours is reduced before the shuffle, and its join is one that can be split.
    """
    first, second = links.columns
    pairs = links.where(F.col(first) != F.col(second)).select(
        F.greatest(first, second).alias("child"), F.least(first, second).alias("parent")
    )
    state = scratch.keep(pairs.mapInArrow(_contracted, _LINKS).distinct(), "links")
    while True:
        both = state.union(state.select("parent", "child"))
        lowest = both.groupBy("child").agg(F.min("parent").alias("low"))
        lowest = lowest.select(F.col("child").alias("node"), F.least("child", "low").alias("low"))
        # large star: every larger neighbour, and the node itself, hangs on the smallest
        near = both.select(F.col("child").alias("node"), F.col("parent").alias("near"))
        large = (
            near.where("near > node").join(lowest, "node").select(F.col("near").alias("child"), F.col("low").alias("parent"))
            .union(lowest.select(F.col("node").alias("child"), F.col("low").alias("parent")))
            .where("child != parent")
        )
        large = scratch.keep(large.distinct().mapInArrow(_contracted, _LINKS).distinct(), "large")
        # small star: a node's parents hang on the smallest of them
        least = large.groupBy("child").agg(F.min("parent").alias("low"), F.count("*").alias("n"))
        small = large.join(least, "child").select("child", "parent", "low")
        small = (
            small.select("child", F.col("low").alias("parent"))
            .union(small.select(F.col("parent").alias("child"), F.col("low").alias("parent")))
            .where("child != parent")
        )
        after = scratch.keep(small.distinct().mapInArrow(_contracted, _LINKS).distinct(), "small")
        scratch.drop(state, large)
        state = after
        # done when every node has one parent and no parent has a parent
        rows, nodes = state.agg(F.count("*"), F.countDistinct("child")).first()
        deeper = state.select(F.col("parent").alias("child")).join(state.select("child"), "child", "left_semi")
        if rows == nodes and deeper.isEmpty():
            return state.select(F.col("child").alias("node"), F.col("parent").alias("component_id"))
