"""A training corpus from raw documents, in five stages.

Each stage works on what the one before kept; its result is written to the shared folder as
Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.forest_dedup import near_copies
from tallyworks.llm.packing import pack_documents
from tallyworks.llm.passage_quality import fit_quality, score_quality
from tallyworks.llm.queries import BYTE_BPE, MIX_LEVELS, mix_weights, with_domain
from tallyworks.llm.scratch import Scratch
from tallyworks.llm.secret_ownership import redact_secrets
from tallyworks.llm.source_mixing import mix_sources
from tallyworks.sources.storage import load

LEAST_QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on part of the labelled ones, does not reject."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    net = fit_quality(docs, load(spark, sf_dir, "labels"), held_out)
    return score_quality(docs, net).where(F.col("quality_score") >= LEAST_QUALITY).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id.

    Rows that repeat a doc_id are one document; rows without a doc_id all stay.
    """
    gone = near_copies(docs).where("NOT kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    return left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).union(left.where("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that look live taken out of their texts."""
    return redact_secrets(docs, F.col("source"), F.concat_ws("/", "source", "lang"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen, whole or at the cut, by target weights with nine tenths of all tokens as the budget."""
    chosen = mix_sources(with_domain(docs), MIX_LEVELS, mix_weights(spark), budget_share=(9, 10), max_epochs=1)
    return chosen.where((F.col("epochs") > 0) | (F.col("last_tokens") > 0)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 token ids."""
    return pack_documents(docs, BYTE_BPE)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]
# the classifier and the tokenizer cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    scratch = Scratch(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        after = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            scratch.drop(before)
        docs = before = after
    return docs
