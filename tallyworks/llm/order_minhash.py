"""Fingerprints that feel edits of order: Order MinHash with DataFrame functions only.

A text's k-mers are numbered by occurrence, so that repeats count and equal texts have
equal sets. Each numbered k-mer is hashed once; the hash space is dealt into bins, and in
each bin the ``tuple`` least k-mers are taken in the order in which they stand in the text.
The hash of that tuple is the bin's sign. Two texts are as like as the share of their used
bins with equal signs, which falls with insertions, deletions and moved passages alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class OrderSettings:
    """k-mers of ``k`` tokens; a token is up to 12 characters other than blanks, with a blank after it."""

    k: int = 3
    bin_bits: int = 6
    tuple: int = 2


def _token_array(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[^ ]{1,12} ?| "), F.lit(0))


def _changes(items: Column, value) -> Column:
    """Places at which ``value`` of an array's item differs from that of the item before."""
    marked = F.transform(
        items,
        lambda x, j: F.when((j == 0) | (value(x) != value(F.get(items, j - 1))), j),
    )
    return F.filter(marked, lambda j: j.isNotNull())


def with_signs(df: DataFrame, text: str, name: str, settings: OrderSettings = OrderSettings()) -> DataFrame:
    """Add ``name``: the signs of a text's used bins, ascending, bin above and 32 bits of hash below.

    Each step is a column of its own, so that none is worked out twice.
    """
    t, s, u, n, b, v = (f"_{name}_{step}" for step in "tsunbv")
    shift, low = 64 - settings.bin_bits, (1 << 32) - 1
    bin_of = lambda g: F.shiftrightunsigned(g, shift)
    df = df.withColumn(t, _token_array(F.col(text)))
    tokens = F.col(t)
    kmers = F.transform(
        tokens,
        lambda x, i: F.struct(F.xxhash64(x, *[F.get(tokens, i + j) for j in range(1, settings.k)]).alias("h"), i.alias("p")),
    )
    count = F.greatest(F.size(tokens) - (settings.k - 1), F.least(F.size(tokens), F.lit(1)))
    df = df.withColumn(s, F.sort_array(F.slice(kmers, F.lit(1), count)))
    # runs of equal k-mers; the place in its run is a k-mer's number
    df = df.withColumn(u, _changes(F.col(s), lambda x: x["h"]))
    runs = F.col(u)
    numbered = F.flatten(
        F.transform(
            runs,
            lambda a, i: F.transform(
                F.slice(F.col(s), a + 1, F.coalesce(F.get(runs, i + 1), F.size(s)) - a),
                lambda x, o: F.struct(F.xxhash64(x["h"], o).alias("g"), x["p"].alias("p")),
            ),
        )
    )
    df = df.withColumn(n, F.sort_array(numbered))
    df = df.withColumn(b, _changes(F.col(n), lambda x: bin_of(x["g"])))
    starts = F.col(b)

    def sign(a, i):
        size = F.least(F.lit(settings.tuple), F.coalesce(F.get(starts, i + 1), F.size(n)) - a)
        least = F.slice(F.col(n), a + 1, size)
        ordered = F.sort_array(F.transform(least, lambda x: F.struct(x["p"].alias("p"), x["g"].alias("g"))))
        hashed = F.xxhash64(F.transform(ordered, lambda x: x["g"]))
        return F.shiftleft(bin_of(F.get(F.col(n), a)["g"]), 32) + hashed.bitwiseAND(F.lit(low))

    return df.withColumn(name, F.array_sort(F.transform(starts, sign))).drop(t, s, u, n, b, v)


def fingerprint_text(signs: Column) -> Column:
    """Signs as text of 10 hexadecimal digits each."""
    return F.array_join(F.transform(signs, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(first: Column, second: Column) -> Column:
    """Equal signs among the bins that either text uses; 1 for two texts without tokens."""
    bins = lambda signs: F.transform(signs, lambda x: F.shiftright(x, 32))
    used = F.size(F.array_union(bins(first), bins(second)))
    return F.when(used == 0, 1.0).otherwise(F.size(F.array_intersect(first, second)) / used)


def with_next(docs: DataFrame, columns: list[str], buckets: int, derived: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add next_<column> of the document after each in descending doc_id order (the last one's is the first).

    ``docs`` has doc_id and text; ``derived`` adds further columns. It is worked out once for
    each row, and again only for the one row that a range's neighbour needs.

    The ids are dealt into ``buckets`` ranges of about equal size and each range is ordered on
    its own; the first row of each range, one row a range, goes to the end of the range before it.
    A null doc_id comes last, equal ids in the order of their rows' hashes. ``docs`` is read more than once.
    """
    tie = F.xxhash64("doc_id", "text")
    shares = [k / buckets for k in range(1, buckets)]
    bounds = docs.select(F.percentile_approx("doc_id", shares, 100 * buckets)).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    edges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    bucket = F.size(F.filter(edges, lambda b: b < F.col("doc_id")))
    placed = docs.withColumn("_bucket", bucket).withColumn("_tie", tie)
    order = [F.col("doc_id").desc_nulls_last(), F.col("_tie").desc()]
    window = Window.partitionBy("_bucket").orderBy(*order)
    inside = derived(placed).select(
        "*", *[F.lead(c).over(window).alias(f"_in_{c}") for c in columns], F.lead(F.lit(True)).over(window).alias("_more")
    )
    # one row a bucket: its first row, and by way of the bucket above which row needs it
    top = placed.groupBy("_bucket").agg(F.max(F.struct("doc_id", "_tie")).alias("_top"))
    by_bucket = Window.orderBy(F.col("_bucket").desc())
    everything = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = top.select(
        F.coalesce(F.lag("_bucket").over(by_bucket), F.last("_bucket").over(everything)).alias("_for"),
        F.col("_top.doc_id").alias("_id"),
        F.col("_top._tie").alias("_id_tie"),
    )
    # at most ``buckets`` rows, found before anything is derived
    found = (
        placed.select("doc_id", "_tie", "text")
        .join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_id_tie")))
        .select("_for", "text")
        .dropDuplicates(["_for"])
    )
    firsts = derived(found).select("_for", F.struct(*columns).alias("_first"))
    # the key is set for the last row of a bucket only, all others have one of their own
    key = F.when(F.col("_more").isNull(), F.col("_bucket").cast("long")).otherwise(-1 - F.abs(F.xxhash64("doc_id", "_tie") % (1 << 40)))
    joined = inside.withColumn("_for", key).join(F.broadcast(firsts), "_for", "left")
    picked = [F.when(F.col("_more"), F.col(f"_in_{c}")).otherwise(F.col(f"_first.{c}")).alias(f"next_{c}") for c in columns]
    return joined.select(*docs.columns, *[c for c in columns if c not in docs.columns], *picked)


def fingerprint_documents(docs: DataFrame, buckets: int, settings: OrderSettings = OrderSettings()) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how like these and the next documents are.

    The edited text has the last floor(n_chars / 3) characters replaced by the first as many of
    the next document in descending doc_id order. ``docs`` has doc_id and text; a null text is
    empty and has an empty fingerprint, repeated rows each have a row, a single document is
    its own next, and no rows give no rows. Other columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(rows, ["text", "signs"], buckets, lambda df: with_signs(df, "text", "signs", settings))
    n = F.length("text")
    tail = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - tail), F.substring("next_text", F.lit(1), tail))
    done = with_signs(paired.withColumn("edited", edited), "edited", "edited_signs", settings)
    return done.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("signs")).alias("fingerprint"),
        fingerprint_text(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
    )
