"""Manifest, filter audit and exact top-k against plain versions, with nulls, ties, repeats and long texts."""

from __future__ import annotations

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import filter_audit, merkle_manifest, pivot_topk
from tallyworks.llm.scratch import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def taken(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(3)

    def prose(n):
        return " ".join(rng.choice(["Aa", "b", "cC", "é", "語", "x1", "50%", "Q"]) + str(rng.randrange(60)) for _ in range(n))

    rows = []
    for i in range(700):  # one language holds most rows, others one, eight, nine, 64 and 65
        lang = {0: None, 1: "", 2: "é"}.get(i, "d8" if i < 11 else "d9" if i < 20 else "d64" if i < 84 else "d65" if i < 149 else "en")
        rows.append((i * 3, prose(rng.choice([0, 3, 49, 50, 60, 200])), lang, rng.choice(["a", "b", None, ""]), i))
    shared = prose(80)
    rows += [(5000 + i, shared, "en", "a", 80) for i in range(40)]  # a group of copies
    rows += [(5010, shared, "en", "a", 80)] * 2  # rows that repeat
    rows += [(5011, "Other TEXT", "en", "b", 1), (5011, "another", "fr", "b", 1)]  # an id for several texts
    rows += [(None, "x Y", "en", "a", 3), (None, "x Y", None, "a", 3), (6000, None, None, None, None), (6003, "", "en", "a", 0)]
    rows += [(6004, None, "en", "a", None), (6006, prose(200_000), "en", "a", 1)]  # a very long text
    rng.shuffle(rows)
    return rows


@pytest.fixture
def docs(spark, documents):
    # extra columns with names that the operators use themselves
    extra = "place long, n long, id string, bits int, path string"
    return spark.createDataFrame([(*row, 1, 1, "i", 7, "p") for row in documents], f"{DOCS}, {extra}").repartition(5)


def as_dicts(rows, schema=DOCS):
    return [dict(zip([part.split()[0] for part in schema.split(", ")], row)) for row in rows]


PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_proofs_equal_those_of_whole_trees(docs, documents):
    got = merkle_manifest.verify_documents(docs)
    assert got.columns == list(PROOF)
    assert taken(got, *PROOF) == sorted(brute.merkle(as_dicts(documents)), key=repr)


@pytest.mark.parametrize(("fan", "stride"), [(2, 1), (2, 3), (3, 2), (8, 1)])
def test_any_fan_and_stride(docs, documents, fan, stride):
    got = merkle_manifest.verify_documents(docs, merkle_manifest.TreeSettings(fan, stride))
    assert taken(got, *PROOF) == sorted(brute.merkle(as_dicts(documents), fan), key=repr)


def test_one_row_and_no_rows(spark, documents):
    alone = spark.createDataFrame(documents[:1], DOCS)
    assert taken(merkle_manifest.verify_documents(alone), *PROOF) == brute.merkle(as_dicts(documents[:1]))
    assert merkle_manifest.verify_documents(spark.createDataFrame([], DOCS)).collect() == []


def test_only_some_levels_are_stored(spark, docs):
    # 700 leaves of the largest language: 4 levels above them, of which two are stored
    manifest = merkle_manifest.build_manifest(docs, F.col("lang"), F.col("doc_id"), merkle_manifest.row_digest(F.col("text")))
    sizes = [level.where("`group` = 'en'").count() for level in manifest.groups.levels]
    assert sizes[0] > 512 and sizes[1:] == [-(-sizes[0] // 64), 1]


def test_a_changed_column_breaks_the_proof(spark, docs):
    manifest = merkle_manifest.build_manifest(docs, F.col("lang"), F.col("doc_id"), merkle_manifest.row_digest(F.col("text")))
    checked = merkle_manifest.proofs(manifest).select(
        (merkle_manifest.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("true"),
        (merkle_manifest.folded(F.sha2("leaf", 256), F.col("path")) == F.col("root")).alias("false"),
    )
    assert checked.distinct().collect() == [(True, False)]


AUDIT = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def labels(documents):
    rows = [(row[0], i % 2, i % 3 == 0) for i, row in enumerate(documents) if i % 4]
    return [(d, q, int(t)) for d, q, t in rows] + [(9, None, None), (9, 1, None), (9, 0, 1), (None, 1, 1), (77_777, 1, 1)]


@pytest.mark.parametrize("crowded", [2000, 5])
def test_every_order_of_the_filters(spark, docs, documents, labels, crowded):
    settings = filter_audit.AuditSettings(crowded=crowded, salts=3)
    frame = spark.createDataFrame([(*row, 5) for row in labels], LABELS + ", bits int")
    got = filter_audit.audit_filters(docs, frame, settings)
    named = [dict(zip(("doc_id", "quality", "toxic"), row)) for row in labels if row[0] is not None]
    assert taken(got, *AUDIT) == sorted(brute.audit(as_dicts(documents), named), key=repr)


def test_later_copies_are_the_failing_rows(spark, docs):
    rows = docs.select("doc_id", "text", "source")
    hashes = rows.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h1"))
    got = filter_audit.later_copies(rows, hashes, Scratch(spark, "test"))
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()
    whole = rows.withColumn("t", F.coalesce("text", F.lit("")))
    first = whole.groupBy("t").agg(F.min("doc_id").alias("first"))
    wanted = whole.join(first, "t").where("first < doc_id").select("doc_id")
    assert sorted(r[0] for r in got.select("id").collect()) == sorted(r[0] for r in wanted.collect())


def test_texts_at_the_thresholds(spark):
    cases = {
        " ".join(f"w{i}" for i in range(49)): 1,
        " ".join(f"w{i}" for i in range(50)): 0,
        "\t\n" + "\x0b".join(f"w{i}" for i in range(50)) + "\r\x0c": 0,
        " ".join(f"w{i % 65}" for i in range(100)): 0,
        " ".join(f"w{i % 64}" for i in range(100)): 2,
        "A" * 5 + "b" * 95: 1,
        "A" * 6 + "b" * 94: 5,
        "É" * 100: 1,  # a capital, but not of A-Z
        "語 | x": 9,
        "^]\\-": 1,
        "\u00a0".join("ab"): 1,
        "": 1,
    }
    df = spark.createDataFrame([(text, bits) for text, bits in cases.items()], "text string, bits int")
    assert df.where(filter_audit.failures(F.col("text")) != F.col("bits")).collect() == []
    assert spark.range(1).select(filter_audit.failures(F.lit(None).cast("string"))).first()[0] == 1


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit_filters(*empty).collect() == []
    got = filter_audit.audit_filters(spark.createDataFrame([(1, None, None, None, None)], DOCS), empty[1])
    assert got.count() == 600 and got.select("part").distinct().collect() == [("",)]


TOP = ("query_id", "rank", "vec_id", "score")
VECTORS = "vec_id long, embedding array<float>"


def search(spark, rows, settings=pivot_topk.TopKSettings(), schema=VECTORS):
    df = spark.createDataFrame([(*row, 1, "s") for row in rows], schema + ", width long, score string").repartition(4)
    got = pivot_topk.top_products(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, settings)
    assert got.columns == list(TOP)
    return taken(got, *TOP)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    near = (centres[rng.integers(12, size=900)] + 0.05 * rng.normal(size=(900, 16))).tolist()
    rows = list(enumerate(near))
    rows += [(1000 + i, [0.25] * 16) for i in range(300)]  # one vector many times: ties
    rows += [(2000, [0.0] * 16), (2050, [0.5, -0.25]), (2051, [0.5, 0.5]), (2052, [])]
    rows += [(2100, None), (2101, [1.0, None]), (2150, [float("nan")] * 16), (2151, [float("inf")] + [0.0] * 15)]
    rows += [(50, near[7]), (50, near[50]), (None, near[3]), (2200, []), (2201, [])]  # ids for several rows
    return rows


SMALL = pivot_topk.TopKSettings(shard_bytes=16 * 8 * 50, wave_rows=3, first_wave=7, growth=2, pivots=4, group_shards=2)


@pytest.mark.parametrize("settings", [pivot_topk.TopKSettings(), SMALL], ids=["usual", "small"])
def test_top_products_equal_brute_force(spark, vectors, settings):
    assert search(spark, vectors, settings) == sorted(brute.top_products(vectors), key=repr)


def test_products_beyond_exact_doubles(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.integers(-(2**20), 2**20, 8) * 2.0).tolist()) for i in range(120)]
    rows += [(50, [2.0**40] * 8)]  # too long: no part
    got = search(spark, rows, schema="vec_id long, embedding array<double>")
    assert got == sorted(brute.top_products(rows[:-1]), key=repr)
    assert max(abs(row[3]) for row in got) > 2**53


@pytest.mark.parametrize("settings", [pivot_topk.TopKSettings(), SMALL], ids=["usual", "small"])
def test_long_vectors_are_candidates(spark, settings):
    """Every pair whose score fits in 64 bits counts, however long its vectors are."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(1000 + i, (10.0**e * rng.normal(size=8)).tolist()) for i, e in enumerate([7, 7, 9, 12, 15, 18, 30, 200])]
    rows += [(1050, [1e12] + [0.0] * 7), (1100, [0.0] * 8), (1150, [1e30, -1e30] + [0.0] * 6), (1151, [1.0, 1.0] + [0.0] * 6)]
    rows += [(1200, [2.0**51, 2.0**51, 1.0] + [0.0] * 5), (1201, [2.0**51, -(2.0**51), 2.0] + [0.0] * 5)]  # all but cancel
    rows += [(1250, [1e9]), (1251, [-1e3]), (1300, [1e300] * 8), (1301, [1e308] * 8)]  # 256 * 1e308 is not finite
    wanted = []
    usable = [(i, v, [math.floor(256 * c) for c in x]) for i, (v, x) in enumerate(rows) if max(map(abs, x)) < 1e308]
    for i, v, x in usable:
        if v % 50 == 0:
            scored = [(-sum(map(int.__mul__, x, y)), w) for j, w, y in usable if j != i and len(x) == len(y)]
            scored = sorted((s, w) for s, w in scored if -(2**63) < s <= 2**63)
            wanted += [(v, rank, w, -s) for rank, (s, w) in enumerate(scored[:5], 1)]
    assert search(spark, rows, settings, "vec_id long, embedding array<double>") == sorted(wanted, key=repr)
    assert {row[2] for row in wanted} >= {1002, 1003, 1050}


def test_fewer_candidates_than_asked_for(spark):
    assert search(spark, [(0, [1.0]), (50, [2.0])]) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    assert search(spark, [(0, [1.0])]) == []
    assert spark.createDataFrame([], VECTORS).transform(
        lambda df: pivot_topk.top_products(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    ).collect() == []


def test_bounds_hold_and_stop_early(vectors):
    """Bounds are never below the product, and near vectors are found without looking at all others."""
    rows = [row for row in vectors if row[0] is not None and row[1] and len(row[1]) == 16]
    matrix = np.array([[x if math.isfinite(x) else 0.0 for x in row[1]] for row in rows])
    matrix = np.floor(256 * matrix)
    pivots = pivot_topk._farthest_first(matrix, 12)
    distances = pivot_topk._distances(matrix, pivots)
    places = np.arange(len(rows))
    whole = pivot_topk._Vectors(16, places, places, np.zeros(len(rows), np.int64), matrix, distances)
    bounds = pivot_topk._bounds(whole, whole)
    products = matrix @ matrix.T
    assert (bounds >= products).all()
    kth = np.sort(products, 1)[:, -5]
    assert (bounds >= kth[:, None]).mean() < 0.6
