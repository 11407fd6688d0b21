"""The operators of this package as queries over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.cap_join import vector_links
from tallyworks.llm.filter_audit import audit_filters
from tallyworks.llm.forest_dedup import near_copies
from tallyworks.llm.merkle_manifest import verify_documents
from tallyworks.llm.order_minhash import fingerprint_documents
from tallyworks.llm.packing import pack_documents
from tallyworks.llm.passage_quality import fit_quality, score_quality
from tallyworks.llm.pivot_topk import top_products
from tallyworks.llm.scratch import Scratch
from tallyworks.llm.secret_ownership import scan_secrets
from tallyworks.llm.source_mixing import mix_sources
from tallyworks.llm.suffix_dedup import remove_repeats
from tallyworks.llm.suffix_tree_lm import score_documents
from tallyworks.llm.token_files import read_token_files, write_token_files
from tallyworks.sources.storage import load

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(load(spark, folder, "documents"))


#: Target weights of the source tree: (domain, language, source, weight); nodes not listed weigh 1.
MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = (
    ("web", None, None, 5),
    ("books", None, None, 3),
    ("forum", None, None, 2),
    ("web", "en", None, 4),
    ("web", "de", None, 2),
    ("books", "en", None, 6),
    ("forum", "es", None, 3),
    ("web", "en", "src3", 2),
    ("books", "en", "src1", 3),
)


def with_domain(docs: DataFrame) -> DataFrame:
    """Adds the domain of a source: the sources are dealt out to three by their number."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,6})$", 1)
    place = F.when(number == "", 2).otherwise(number.try_cast("int") % 3)
    return docs.withColumn("domain", F.get(F.array(F.lit("web"), F.lit("books"), F.lit("forum")), place))


def mix_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MIX_WEIGHTS), "domain string, lang string, source string, weight int")


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(load(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    return mix_sources(docs, MIX_LEVELS, mix_weights(spark)).drop("text")


def op3_cap_join(spark: SparkSession, folder: str) -> DataFrame:
    return vector_links(load(spark, folder, "embeddings"))


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fingerprint_documents(load(spark, folder, "documents"), buckets)


def op5_suffix_tree_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(load(spark, folder, "documents"), _remainder(7) == 2)


def op6_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(load(spark, folder, "documents"), BYTE_BPE)


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "tokens")
    target = scratch.path("files")
    manifest = scratch.keep(write_token_files(load(spark, folder, "documents"), target, BYTE_BPE), "manifest")
    return read_token_files(spark, target, manifest)


def op8_forest_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(load(spark, folder, "documents"))


def op9_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    return scan_secrets(docs, F.col("source"), F.concat_ws("/", "source", "lang"))


def op10_passage_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = load(spark, folder, "documents"), _remainder(4) == 2
    net = fit_quality(docs, load(spark, folder, "labels"), held_out)
    scored = score_quality(docs.select("doc_id", "text"), net)
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.when(F.col("quality_score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return verify_documents(load(spark, folder, "documents"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op13_pivot_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(load(spark, folder, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_cap_join": op3_cap_join,
    "op4_order_minhash": op4_order_minhash,
    "op5_suffix_tree_lm": op5_suffix_tree_lm,
    "op6_harmonic_packing": op6_harmonic_packing,
    "op7_token_files": op7_token_files,
    "op8_forest_dedup": op8_forest_dedup,
    "op9_secret_ownership": op9_secret_ownership,
    "op10_passage_quality": op10_passage_quality,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_pivot_topk": op13_pivot_topk,
}
