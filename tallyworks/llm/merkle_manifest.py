"""Merkle manifest of a dataset, with only every few levels of its trees stored.

Every row is a leaf. The leaves of a group (a language) ascend by key; runs of ``fan`` nodes
become their digest, level by level, up to the group's root; the groups' roots, in order of
group, are the leaves of one more tree, whose top is the root of the dataset.

``build_manifest`` stores the leaves and every ``stride``-th level above them: the checkpoints.
``proofs`` walks the checkpoints downwards. A node's proof is that of the checkpoint above it
with the siblings inside the aligned subtree between the two put in front; the nodes inside
that subtree are worked out again from its lowest nodes, give their siblings and are not kept.
A subtree holds ``fan ** stride`` nodes however the rows are dealt out to groups, so a group
with most rows is as well spread as any other.

All of it are DataFrame functions: digests are lowercase hex text, a proof is a list of what
stands left and right of a node in its run, lowest level first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.scratch import Scratch
from tallyworks.operators.numbering import number_rows

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NO_STEPS = "CAST(array() AS array<struct<left: string, right: string>>)"


@dataclass(frozen=True)
class TreeSettings:
    """Nodes in a run, and levels from one stored level to the next."""

    fan: int = 8
    stride: int = 2


@dataclass(frozen=True)
class _Tree:
    """Stored levels of one tree per group: ``group``, ``place`` on the level (from 0), ``digest``."""

    levels: list[DataFrame]
    settings: TreeSettings


@dataclass(frozen=True)
class Manifest:
    """The trees of the groups and the tree above them."""

    groups: _Tree
    top: _Tree


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as part of a leaf: ``-`` for null, else its length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    return digest(*[field(value) for value in values])


def _runs(nodes: Column, fan: int) -> Column:
    """Digests of the runs of ``fan`` nodes of a list, the last run with what is left."""
    last = F.ceil(F.size(nodes) / fan).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda run: F.sha2(F.array_join(F.slice(nodes, run * fan + 1, F.lit(fan)), ""), 256),
    )


def _many(settings: TreeSettings, level: int) -> Column:
    """Whether a group has more than one node ``level`` levels above the nodes of its subtrees.

    A subtree knows by itself: it is not its group's first, or as large as all of its group.
    """
    return (F.col("subtree") > 0) | (F.size("nodes_0") > settings.fan**level)


def _subtrees(nodes: DataFrame, settings: TreeSettings, carried: Column) -> DataFrame:
    """A row for each aligned subtree over a level: ``members`` with what they carry, and all nodes inside.

    ``nodes_0`` are the members' digests, ``nodes_1`` and so on the levels above, as far as the group has them.
    """
    wide = settings.fan**settings.stride
    subtrees = (
        nodes.groupBy("group", F.expr(f"place div {wide}").alias("subtree"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", carried.alias("carried")))).alias("members"))
        .withColumn("nodes_0", F.col("members.digest"))
    )
    for level in range(settings.stride):
        below = F.col(f"nodes_{level}")
        above = F.when(_many(settings, level), _runs(below, settings.fan)).otherwise(below)
        subtrees = subtrees.withColumn(f"nodes_{level + 1}", above)
    return subtrees


def _nothing() -> Column:
    return F.lit(None).cast("string")


def _grow(leaves: DataFrame, settings: TreeSettings, scratch: Scratch, name: str) -> _Tree:
    """Store every ``stride``-th level over ``leaves``, up to the level where every group has one node."""
    levels = [leaves]
    tallest = leaves.agg(F.max("place")).first()[0] or 0
    while tallest > 0:
        above = _subtrees(levels[-1], settings, _nothing()).select(
            "group",
            F.col("subtree").alias("place"),
            F.get(F.col(f"nodes_{settings.stride}"), F.lit(0)).alias("digest"),
        )
        levels.append(scratch.keep(above, f"{name}-level-{len(levels) * settings.stride}"))
        tallest //= settings.fan**settings.stride
    return _Tree(levels, settings)


def _steps(settings: TreeSettings) -> Column:
    """The steps of member ``i`` of a subtree through the levels inside it."""
    fan, steps = settings.fan, []
    for level in range(settings.stride):
        nodes = F.col(f"nodes_{level}")
        own = F.expr(f"i div {fan**level}").cast("int")
        start = F.expr(f"i div {fan ** (level + 1)} * {fan}").cast("int")  # of its run
        end = F.least(start + fan, F.size(nodes))
        step = F.struct(
            F.array_join(F.slice(nodes, start + 1, own - start), "").alias("left"),
            F.array_join(F.slice(nodes, own + 2, end - own - 1), "").alias("right"),
        )
        steps.append(F.when(_many(settings, level), F.array(step)).otherwise(F.expr(_NO_STEPS)))
    return F.concat(*steps)


def _paths(tree: _Tree, tops: DataFrame, carried: Column) -> DataFrame:
    """``group``, ``digest``, ``carried``, ``path`` and ``summary`` of every leaf.

    ``tops`` has a row per group: its path from its root on, and the summary its leaves are given.
    """
    tops = tops.select(F.col("group").alias("of"), "path", "summary")
    above = tree.levels[-1].join(tops, F.col("group").eqNullSafe(F.col("of")))
    if len(tree.levels) == 1:
        return above.select("group", "digest", carried.alias("carried"), "path", "summary")
    for depth in range(len(tree.levels) - 2, -1, -1):
        subtrees = _subtrees(tree.levels[depth], tree.settings, carried if depth == 0 else _nothing())
        upper = above.select(F.col("group").alias("of"), F.col("place").alias("at"), F.col("path").alias("upper"), "summary")
        same = F.col("group").eqNullSafe(F.col("of")) & (F.col("subtree") == F.col("at"))
        members = subtrees.join(upper, same).select("*", F.posexplode("members").alias("i", "member"))
        path = F.concat(_steps(tree.settings), F.col("upper")).alias("path")
        above = members.select("group", "member.*", path, "summary")
    return above


def build_manifest(
    rows: DataFrame, group: Column, key: Column, leaf: Column, settings: TreeSettings = TreeSettings(), **carry: Column
) -> Manifest:
    """Number the leaves of each group by ``key``, equal keys by digest, and store the checkpoints.

    ``carry`` names small columns that stay with a leaf. Rows are read once; a leaf stands for
    its row from there on. Equal leaves may stand in either order. A null group is a group, a
    null key comes first; no rows make no tree.
    """
    scratch = Scratch(rows.sparkSession, "merkle")
    carried = [key.alias("key"), *[column.alias(name) for name, column in carry.items()]]
    read = scratch.keep(rows.select(group.alias("group"), leaf.alias("digest"), *carried), "rows")
    leaves = number_rows(read, ["key", "digest"], "_number", within=["group"]).withColumn("place", F.col("_number") - 1)
    scratch.drop(read)  # the numbering has stored it anew
    trees = _grow(leaves.drop("_number"), settings, scratch, "group")
    roots = number_rows(trees.levels[-1].select("group", "digest"), ["group"], "_number")
    tops = roots.select(
        F.lit("").alias("group"), (F.col("_number") - 1).alias("place"), "digest", F.col("group").alias("of_group")
    )
    return Manifest(trees, _grow(scratch.keep(tops, "roots"), settings, scratch, "top"))


def proofs(manifest: Manifest) -> DataFrame:
    """For every leaf: ``group``, ``leaf``, what it carries, ``subroot``, ``root`` and its ``path`` to the root."""
    summit = manifest.top.levels[-1].select("group", F.expr(_NO_STEPS).alias("path"), F.col("digest").alias("summary"))
    roots = _paths(manifest.top, summit, F.col("of_group")).select(
        F.col("carried").alias("group"),
        "path",
        F.struct(F.col("digest").alias("subroot"), F.col("summary").alias("root")).alias("summary"),
    )
    own = [name for name in manifest.groups.levels[0].columns if name not in ("group", "place", "digest")]
    paths = _paths(manifest.groups, roots, F.struct(*own))
    return paths.select("group", F.col("digest").alias("leaf"), "carried.*", "summary.*", "path")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof make."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def verify_documents(docs: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """Manifest of ``documents`` by language, every proof, and a check of each against a tampered text.

    A third of the documents, by a checksum of doc_id, are checked with their text's A-Z in lower case.
    Such a text without capital letters, or null, is as it was and passes.

    Rows that repeat a doc_id are leaves of their own in the order of their digests. A null doc_id comes first in
    its language and is not tampered with; a null lang is a language; null texts are ``-``, empty ones ``0:``.
    An empty table gives no rows. Columns other than those of ``documents`` play no part.
    """
    names = ("doc_id", "source", "lang", "n_chars", "text")
    columns = {name: F.col(name) for name in names}
    tampered = {**columns, "text": F.translate("text", UPPER, UPPER.lower())}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    manifest = build_manifest(
        docs,
        F.col("lang"),
        F.col("doc_id"),
        row_digest(*columns.values()),
        settings,
        tampered=F.when(chosen, row_digest(*tampered.values())),
    )
    checked = proofs(manifest).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return checked.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
