"""Secrets in texts and who owns them, with DataFrame functions only.

Patterns give candidates. Each candidate's hash is counted over the whole corpus by the
owners and repositories that hold it: a value that many owners have is a copied example,
one that few have looks live. Long mixed tokens that no pattern names count as secrets only
if few owners have them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.scratch import Scratch

# The patterns of the base kinds, in the order in which they are listed
ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
    "[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
MIXED = "[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")


@dataclass(frozen=True)
class SecretSettings:
    """A value with ``example_owners`` owners or more is an example; mixed tokens have 20 characters or more."""

    example_owners: int = 3
    assign_length: int = 6


def _matches(text: Column, kind: int, pattern: str, value) -> Column:
    """Matches of a pattern with the lengths of the gaps before them, where there are any."""
    gaps = F.split(text, pattern, -1)
    found = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("place"),
            F.length(F.get(gaps, i)).cast("long").alias("gap"),
            F.length(m).cast("long").alias("size"),
            value(m).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,place:int,gap:bigint,size:bigint,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def find_secrets(docs: DataFrame, owner: Column, repository: Column, settings: SecretSettings = SecretSettings()) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): one row per document (row, doc_id, text_key), and its secrets.

    Spans have row, kind (place in KINDS), start and end in code points (end exclusive),
    n_owners, n_repositories and live. Base kinds are leftmost matches that do not overlap within
    their kind, whatever their owners; an ``owned`` span is a mixed token outside all base spans
    with fewer owners than an example has. A null owner or repository is one of its own.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    whole = lambda m: m
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = [
        _matches(text, 0, ASSIGN, lambda m: F.regexp_extract(m, ASSIGN, 2)),
        _matches(text, 1, ACCESS, whole),
        _matches(text, 2, HEX, whole),
        _matches(text, 3, MIXED, whole),
    ]
    # one pass over the texts: a row for each match, and one for each document without any
    matches = scratch.keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.xxhash64("doc_id", "text").alias("text_key"),
            owner.cast("string").alias("owner"),
            repository.cast("string").alias("repository"),
            F.flatten(F.array(*kinds)).alias("found"),
        )
        .select("row", "doc_id", "text_key", "owner", "repository", F.explode_outer("found").alias("m"))
        .select("row", "doc_id", "text_key", "owner", "repository", "m.kind", "m.place", "m.gap", "m.size", F.length("m.value").alias("length"), F.sha2("m.value", 256).alias("hash"),
                (F.col("m.value").rlike("[0-9]") & F.col("m.value").rlike("[A-Za-z]")).alias("mixed")),
        "matches",
    )
    along = Window.partitionBy("row", "kind").orderBy("place")
    spans = matches.where("kind IS NOT NULL").withColumn("end", F.sum(F.col("gap") + F.col("size")).over(along))
    spans = spans.withColumn("start", F.col("end") - F.col("size"))
    spans = spans.where(
        ((F.col("kind") == 0) & (F.col("length") >= settings.assign_length)) | F.col("kind").isin(1, 2) | ((F.col("kind") == 3) & F.col("mixed"))
    )
    spans = scratch.keep(spans.select("row", "kind", "start", "end", "hash", "owner", "repository"), "spans")
    # owners first, so that a value held by everyone is counted before it is shuffled
    owners = (
        spans.select("hash", "owner", "repository").distinct()
        .groupBy("hash", "owner").agg(F.count("*").alias("n"))
        .groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))
    )
    judged = spans.drop("owner", "repository").join(owners, "hash").withColumn("live", F.col("n_owners") < settings.example_owners)
    base = judged.where("kind < 3")
    covered = base.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("base"))
    inside = F.exists("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    owned = judged.where("kind = 3 AND live").join(covered, "row", "left").where(~F.coalesce(inside, F.lit(False)))
    found = base.drop("hash").unionByName(owned.drop("hash", "base"))
    rows = matches.select("row", "doc_id", "text_key").dropDuplicates(["row"])
    return rows, found


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def scan_secrets(docs: DataFrame, owner: Column, repository: Column, settings: SecretSettings = SecretSettings()) -> DataFrame:
    """Counts and places of the secrets of every document.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256 and spans (see ``find_secrets``), and
    n_owned, n_live and n_example. A null text is empty; documents without secrets have zeros and
    an empty list; repeated rows each have a row; no rows give no rows.
    """
    rows, spans = find_secrets(docs, owner, repository, settings)
    span = F.struct("start", "kind", "end")
    per_row = spans.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.count_if(F.col("live")).alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
        F.array_sort(F.collect_list(span)).alias("all"),
    )
    counts = ("n_assign", "n_access", "n_hex", "n_owned", "n_live", "n_example")
    every = F.coalesce(F.col("all"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts[:3]],
        F.sha2(_listed(F.filter(every, lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts[3:]],
    )


def redact_secrets(docs: DataFrame, owner: Column, repository: Column, mark: str = "[secret]", settings: SecretSettings = SecretSettings()) -> DataFrame:
    """``docs`` with every live secret's span replaced by ``mark``; n_chars, if there, follows the text.

    Copied examples stay. Rows, their columns and their order of columns stay as they are.
    """
    rows, spans = find_secrets(docs, owner, repository, settings)
    live = spans.where("live").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_live"))
    by_text = rows.join(live, "row").groupBy(F.col("text_key").alias("_key")).agg(F.first("_live").alias("_live"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def step(state, span):
        gap = F.greatest(span["start"] - state["at"], F.lit(0))
        kept = F.substring(F.col("text"), (state["at"] + 1).cast("int"), gap.cast("int"))
        touching = span["start"] < state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(touching, state["done"]).otherwise(F.concat(state["done"], kept, F.lit(mark))).alias("done"),
        )

    def finish(state):
        return F.concat(state["done"], F.substring(F.col("text"), (state["at"] + 1).cast("int"), F.length("text")))

    new_text = F.when(F.col("_live").isNull(), F.col("text")).otherwise(F.aggregate("_live", start, step, finish))
    joined = docs.withColumn("_key", F.xxhash64("doc_id", "text")).join(by_text, "_key", "left").withColumn("_new", new_text)
    changed = {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_live").isNull(), F.col("n_chars")).otherwise(F.length("_new").cast("long"))
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
