"""A quality classifier that reads a document as a bag of passages.

Attention-based multiple-instance learning: every passage of a whole text is encoded,
gated attention gives each passage a weight, and the weighted sum of the encodings
gives the document's score. Only documents have labels; which passages tell is learnt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyworks.llm.words import distinct_per_row, mix, parts, shingle_hashes, text_bytes, word_hashes
from tallyworks.sources.shipping import ship

_BUCKETS = 64
_KINDS = 5
_WIDTH = _BUCKETS + _KINDS + 5


@dataclass(frozen=True)
class QualitySettings:
    """Passages, network and training.

    The network is fitted on at most ``sample`` labelled documents, those with the smallest
    hash of their doc_id, with at most ``bag`` evenly spaced passages of each; it then
    scores every passage of every document.
    """

    passage: int = 64  # words
    hidden: int = 24
    gate: int = 12
    sample: int = 4000
    bag: int = 64
    epochs: int = 40
    rate: float = 0.004
    decay: float = 1e-4
    seed: int = 7


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, 3, np.uint8)  # punctuation and signs
    kinds[48:58] = 0
    kinds[65:91] = 1
    kinds[97:123] = 2
    kinds[128:] = 2
    kinds[[9, 10, 11, 12, 13, 32]] = 4
    return kinds


_KIND_OF = _byte_kinds()


def passage_features(column: pa.Array, settings: QualitySettings) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages in order, and the number of passages of each text (1 at least)."""
    words, counts = word_hashes(column)
    rows = len(counts)
    per_row = np.maximum(1, -(-counts // settings.passage))
    firsts = np.cumsum(per_row) - per_row
    row_of_word = np.repeat(np.arange(rows), counts)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    passage = firsts[row_of_word] + place // settings.passage
    total = int(per_row.sum())
    out = np.zeros((total, _WIDTH), np.float32)
    sizes = np.maximum(np.bincount(passage, minlength=total), 1)
    bucket = (mix(words) % np.uint64(_BUCKETS)).astype(np.int64)
    shares = np.bincount(passage * _BUCKETS + bucket, minlength=total * _BUCKETS)
    out[:, :_BUCKETS] = np.sqrt(shares.reshape(total, _BUCKETS) / sizes[:, None])

    distinct = distinct_per_row(words, np.bincount(passage, minlength=total))[1]
    out[:, _BUCKETS + _KINDS] = distinct / sizes
    raw, offsets = text_bytes(column)
    lengths = np.diff(offsets)
    kinds = np.zeros((rows, _KINDS))
    if len(raw):
        of = np.repeat(np.arange(rows), lengths)
        kinds = np.bincount(of * _KINDS + _KIND_OF[raw], minlength=rows * _KINDS).reshape(rows, _KINDS)
    whole = np.zeros((rows, _KINDS + 4))
    whole[:, :_KINDS] = kinds / np.maximum(lengths, 1)[:, None]
    own = distinct_per_row(words, counts)[1]
    runs, run_counts = shingle_hashes(words, counts, 3)
    run_own = distinct_per_row(runs, run_counts)[1]
    whole[:, _KINDS] = own / np.maximum(counts, 1)
    whole[:, _KINDS + 1] = run_own / np.maximum(run_counts, 1)
    whole[:, _KINDS + 2] = np.log1p(counts) / 10
    whole[:, _KINDS + 3] = np.minimum(lengths / np.maximum(counts, 1), 40) / 10
    of_passage = np.repeat(np.arange(rows), per_row)
    out[:, _BUCKETS : _BUCKETS + _KINDS] = whole[of_passage, :_KINDS]
    out[:, _BUCKETS + _KINDS + 1 :] = whole[of_passage, _KINDS:]
    return out, per_row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionNet:
    """Passage encoder, gated attention and a logistic output over the weighted sum."""

    def __init__(self, width: int, settings: QualitySettings):
        rng = np.random.default_rng(settings.seed)
        h, g = settings.hidden, settings.gate
        scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.p = {"W": scale(width, h), "b": np.zeros(h), "V": scale(h, g), "U": scale(h, g), "w": scale(g), "c": scale(h), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(width), np.ones(width)

    def forward(self, x: np.ndarray, sizes: np.ndarray):
        p, firsts = self.p, np.cumsum(sizes) - sizes
        x = (x - self.mean) / self.scale
        h = np.maximum(x @ p["W"] + p["b"], 0)
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logit = (v * u) @ p["w"]
        top = np.maximum.reduceat(logit, firsts)
        e = np.exp(logit - np.repeat(top, sizes))
        a = e / np.repeat(np.add.reduceat(e, firsts), sizes)
        z = np.add.reduceat(a[:, None] * h, firsts, axis=0)
        y = _sigmoid(z @ p["c"] + p["d"])
        return y, (x, h, v, u, a, z, firsts)

    def gradient(self, x, sizes, target, weight):
        p = self.p
        y, (x, h, v, u, a, z, firsts) = self.forward(x, sizes)
        dy = (y - target) * weight / weight.sum()
        dz = np.repeat(dy[:, None] * p["c"], sizes, axis=0)
        da = (dz * h).sum(1)
        dl = a * (da - np.repeat(np.add.reduceat(a * da, firsts), sizes))
        dv, du = dl[:, None] * p["w"] * u * (1 - v * v), dl[:, None] * p["w"] * v * u * (1 - u)
        dh = (a[:, None] * dz + dv @ p["V"].T + du @ p["U"].T) * (h > 0)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ dl, "c": z.T @ dy, "d": np.array([dy.sum()])}

    def fit(self, x: np.ndarray, sizes: np.ndarray, target: np.ndarray, settings: QualitySettings) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        rng = np.random.default_rng(settings.seed)
        firsts = np.cumsum(sizes) - sizes
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(settings.epochs):
            order = rng.permutation(len(sizes))
            for some in np.array_split(order, max(1, len(order) // 128)):
                step += 1
                at = np.concatenate([np.arange(firsts[k], firsts[k] + sizes[k]) for k in some])
                grads = self.gradient(x[at], sizes[some], target[some], np.ones(len(some)))
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] = self.p[k] - settings.rate * (move + settings.decay * self.p[k])


class ConstantNet:
    """Stands in when the labels have fewer than two values."""

    def __init__(self, value: float):
        self.value = value

    def forward(self, x: np.ndarray, sizes: np.ndarray):
        return np.full(len(sizes), self.value), None


def fit_quality(docs: DataFrame, labels: DataFrame, held_out: Column, settings: QualitySettings = QualitySettings()):
    """Fit on a bounded sample of labelled documents for which ``held_out`` is not true.

    ``labels`` has doc_id and quality (0 or 1; null labels are left out; of several for one
    doc_id the largest counts). Without labels the score is 0.5, with one label value near it.
    """
    ship(docs.sparkSession)
    given = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    free = ~F.coalesce(held_out, F.lit(False))
    chosen = given.where(free).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    # at most ``sample`` rows
    sample = docs.where(free).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text"):
                x, sizes = passage_features(batch.column("text"), settings)
                rows, at = [], 0
                for n in sizes:
                    keep = np.unique(np.linspace(at, at + n - 1, min(n, settings.bag)).astype(np.int64))
                    rows.append(x[keep].astype("<f4").tobytes())
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("quality").cast(pa.int32()), pa.array(rows, pa.binary())], ["doc_id", "quality", "bag"]
                )

    found = sample.mapInArrow(run, "doc_id long, quality int, bag binary").toArrow().sort_by("doc_id")
    target = found["quality"].to_numpy().astype(np.float64)
    if len(set(target.tolist())) < 2:
        return ConstantNet(0.5 if not len(target) else (target.sum() + 1) / (len(target) + 2))
    bags = [np.frombuffer(b, "<f4").reshape(-1, _WIDTH) for b in found["bag"].to_pylist()]
    net = AttentionNet(_WIDTH, settings)
    net.fit(np.concatenate(bags).astype(np.float64), np.array([len(b) for b in bags]), target, settings)
    return net


def score_quality(docs: DataFrame, net, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """All columns of ``docs`` and ``quality_score`` in 0 to 1, from the whole text alone.

    A null or empty text is one passage without words. A column named quality_score is replaced.
    """
    ship(docs.sparkSession)
    docs = docs.drop("quality_score")
    schema = StructType([*docs.schema.fields, StructField("quality_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text", 1 << 20):
                x, sizes = passage_features(batch.column("text"), settings)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(net.forward(x, sizes)[0])], [*batch.schema.names, "quality_score"]
                )

    return docs.mapInArrow(run, schema)
