"""Scores of texts by a probabilistic suffix tree over words.

The corpus is counted level by level. A context is a state of the tree when it occurs more
than once and its next-symbol distribution diverges from that of its suffix; a state keeps
explicit entries for the next symbols seen there more than once and leaves the rest of its
mass to the suffix. A symbol's probability is taken at the longest suffix of what precedes
it that is a state.

The tree grows with the corpus and is never in one place. Documents lie in chunks, as numbers
of words. Each chunk sends its different words, pairs or triples, once each, to buckets by
hash; a bucket adds up what all chunks sent and answers each of them in the order of its keys.
A pair is sent only if both of its words occur twice, a triple only if both of its pairs do.
One chunk of those that sent a key owns it and adds its entry to the sums of the context,
which go to buckets likewise. A document's score is then a sum of figures that its chunk has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.scratch import Scratch
from tallyworks.llm.words import mix, parts, word_hashes

_END = np.uint64(0x5DEECE66D1234567)
_CHUNK = 1 << 20  # tokens of a chunk; a text is never cut
_BUCKET = 1 << 21  # tokens of the corpus for each bucket at most
_TASK_BITS = 33
_PAIR, _TRIPLE = 17, 29  # turns of the first of two hashes that are joined into one
_WORDS, _PAIRS, _TRIPLES, _STATES, _DEEPER = range(5)  # what is asked for

_CHUNKS = "chunk long, tokens long, doc_ids array<long>, held array<boolean>, sizes binary, words binary, places binary"
_ASKS = "kind int, chunk long, bucket int, keys binary, n binary, seen binary, gain binary, share binary"
_ANSWERS = "kind int, chunk long, bucket int, found binary, total long, distinct long"


@dataclass(frozen=True)
class TreeSettings:
    """Parameters of the tree."""

    hot_share: float = 1e-6  # without effect: figures are asked for alike, whatever their share of the training tokens
    least: int = 2  # times that contexts and entries occur
    divergence: float = 0.02  # least divergence from the suffix, in bits a symbol
    smoothing: float = 2.0  # counts added for the suffix's distribution


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all symbols with one end per row, the row of each, and symbols per row."""
    hashes, counts = word_hashes(column)
    rows = np.arange(len(counts))
    row_of_word = np.repeat(rows, counts)
    out = np.full(len(hashes) + len(counts), _END, np.uint64)
    out[np.arange(len(hashes)) + row_of_word] = hashes
    return out, np.repeat(rows, counts + 1), counts + 1


def _joined(first: np.ndarray, second: np.ndarray, turn: int) -> np.ndarray:
    return ((first << np.uint64(turn)) | (first >> np.uint64(64 - turn))) ^ second


def _packed(values: np.ndarray) -> bytes:
    """An array compressed byte by byte of its values, after their number."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(packed[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(packed[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))  # steps between sorted keys have zeros in front


def _unpacked_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(packed, "u8"), dtype=np.uint64)  # a step back goes round


def _packed_few(values: np.ndarray) -> bytes:
    """An array of few different values, as these and their numbers."""
    distinct, number = np.unique(values, return_inverse=True)
    head = _packed(distinct)
    return len(head).to_bytes(8, "little") + head + _packed(number.astype("<i4"))


def _unpacked_few(packed: bytes, kind: str) -> np.ndarray:
    end = 8 + int.from_bytes(packed[:8], "little")
    return _unpacked(packed[8:end], kind)[_unpacked(packed[end:], "<i4")]


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    """Columns by a schema's names; a list of values or an array each."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    kinds |= {"array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    fields = [field.split() for field in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of some tokens in one row: different words, and the number of each token's word."""
    task, done, held, size = TaskContext.get().partitionId(), 0, [], 0

    def chunk() -> pa.RecordBatch:
        symbols, sizes = (np.concatenate([one[k] for one in held]) for k in (0, 1))
        words, places, counts = np.unique(symbols, return_inverse=True, return_counts=True)
        # frequent words have small numbers, those equally frequent are sorted: both compress
        order = np.argsort(-counts, stable=True)
        numbers = np.empty(len(words), "<i4")
        numbers[order] = np.arange(len(words))
        doc_ids, flags = ([x for one in held for x in one[k].to_pylist()] for k in (2, 3))
        packed = [_packed(sizes), _packed_keys(words[order]), _packed(numbers[places])]
        return _batch(_CHUNKS, [[(task << _TASK_BITS) + done], [len(symbols)], [doc_ids], [flags], *([one] for one in packed)])

    for whole in batches:
        for batch in parts(whole, "text", 1 << 20):
            symbols, _, sizes = _symbols(batch.column("text"))
            held.append((symbols, sizes, batch.column("doc_id"), batch.column("held_out")))
            size += len(symbols)
            if size >= _CHUNK:
                yield chunk()
                done, held, size = done + 1, [], 0
    if size:
        yield chunk()


class _Chunk:
    """A chunk's tokens with what has been answered so far."""

    def __init__(self, row: dict, answers: pa.Table | None, settings: TreeSettings, size: int = 1):
        self.id, self.doc_ids, self.held = row["chunk"], row["doc_ids"], row["held"]
        self.sizes = _unpacked(row["sizes"], "<i8")
        numbered = _unpacked_keys(row["words"])
        order = np.argsort(numbered)
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order))
        self.words, self.places = numbered[order], number[_unpacked(row["places"], "<i4")]
        self.rows = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.train = ~np.array(self.held, bool)[self.rows]
        self._settings, self._size, self._found = settings, size, {}
        if answers is not None:
            answers = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
            for kind, found in zip(answers["kind"].to_pylist(), answers["found"].to_pylist()):
                self._found.setdefault(kind, []).append(found)

    def found(self, kind: int, expected: int) -> np.ndarray:
        """What was answered for all keys of a kind, in their order."""
        form = "<f8" if kind in (_STATES, _DEEPER) else "<i8"
        found = [_unpacked_few(one, form) for one in self._found.pop(kind, [])]
        out = np.concatenate(found) if found else np.zeros(0, form)
        if len(out) != expected:
            raise ValueError(f"{len(out)} answers for {expected} keys")
        return out

    def count_words(self) -> None:
        self.n = self.found(_WORDS, len(self.words)) >> 1
        self.often = self.n >= self._settings.least
        self.root = (self.n + 1) / self._size

    def meet_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Different pairs of words that both occur often, and how often each does in training rows."""
        fit = self.often[self.places]
        self.at2 = np.flatnonzero((self.rows[1:] == self.rows[:-1]) & fit[1:] & fit[:-1]) + 1
        joined = _joined(self.words[self.places[self.at2 - 1]], self.words[self.places[self.at2]], _PAIR)
        self.pairs, self.pair_of, counts = _distinct(mix(joined), self.train[self.at2])
        return self.pairs, counts

    def count_pairs(self) -> None:
        found = self.found(_PAIRS, len(self.pairs))
        self.pair_n, self.pair_owned = found >> 1, (found & 1).astype(bool)
        self.pair_often = self.pair_n >= self._settings.least
        some = np.empty(len(self.pairs), np.int64)
        some[self.pair_of] = self.at2
        self.first, self.second = self.places[some - 1], self.places[some]

    def meet_triples(self) -> tuple[np.ndarray, np.ndarray]:
        """Different triples whose pairs both occur often, and how often each does in training rows."""
        here = np.full(len(self.places), -1, np.int32)
        fit = self.pair_often[self.pair_of]
        here[self.at2[fit]] = self.pair_of[fit]
        self.at3 = np.flatnonzero((here[1:] >= 0) & (here[:-1] >= 0)) + 1
        before, last = here[self.at3 - 1], here[self.at3]
        joined = _joined(self.pairs[before], self.pairs[last], _TRIPLE)
        triples, self.triple_of, counts = _distinct(mix(joined), self.train[self.at3])
        self.context, self.last = np.empty(len(triples), np.int32), np.empty(len(triples), np.int32)
        self.context[self.triple_of], self.last[self.triple_of] = before, last
        return triples, counts

    def count_triples(self) -> None:
        found = self.found(_TRIPLES, len(self.context))
        self.triple_n, self.triple_owned = found >> 1, (found & 1).astype(bool)
        self.triple_often = self.triple_n >= self._settings.least

    def enter_pairs(self) -> None:
        """The share ``rest`` that each word leaves to its suffix, and what each pair has by that."""
        self.rest = np.ones(len(self.words))
        self.rest[self.often] = self.found(_STATES, int(self.often.sum()))
        left = self.rest[self.first] * self.root[self.second]
        entry = self.pair_n / (self.n[self.first] + self._settings.smoothing)
        self.share = left + np.where(self.pair_often & (self.rest[self.first] < 1), entry, 0)
        self.pair_gain = np.log10(self.share / left)

    def enter_triples(self) -> None:
        self.pair_rest = np.ones(len(self.pairs))
        self.pair_rest[self.pair_often] = self.found(_DEEPER, int(self.pair_often.sum()))
        left = self.pair_rest[self.context] * self.share[self.last]
        entry = self.triple_n / (self.pair_n[self.context] + self._settings.smoothing)
        share = left + np.where(self.triple_often & (self.pair_rest[self.context] < 1), entry, 0)
        self.triple_gain = np.log10(share / left)

    def scores(self, total: int) -> pa.RecordBatch:
        known = self.n > 0
        base = np.log10(self.n + 1) - np.log10(self._size)
        # a state's rest applies to every occurrence of its context, as a symbol always follows
        score = (base + np.log10(self.rest))[self.places]
        score[self.at2] += (self.pair_gain + np.log10(self.pair_rest))[self.pair_of]
        score[self.at3] += self.triple_gain[self.triple_of]
        n = len(self.sizes)
        columns = [np.bincount(self.rows, x, n) for x in (known[self.places], base[self.places], score)]
        whole = [self.doc_ids, self.held, self.sizes, columns[0].astype(np.int64), np.full(n, total), *columns[1:]]
        return _batch(_SCORES, whole)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _distinct(keys: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(keys, return_inverse=True)
    inverse = inverse.astype(np.int32)
    return distinct, inverse, np.bincount(inverse[counted], minlength=len(distinct))


def _asks(kind, chunk: int, buckets: int, keys: np.ndarray, n: np.ndarray, *sums: np.ndarray, half: int | None = None) -> pa.RecordBatch:
    """A row for each bucket (or those of a half) of sorted keys: ranges of their upper 24 bits."""
    bounds = (np.arange(1, buckets, dtype=np.uint64) << np.uint64(24)) // np.uint64(buckets) << np.uint64(40)
    cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    own = [(b, slice(x, y)) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if x < y and half in (None, b % 2)]
    packed = [[_packed(values[of]) for _, of in own] for values in (n, *sums)]
    packed += [[None] * len(own)] * (4 - len(packed))
    about = [[kind] * len(own), [chunk] * len(own), [b for b, _ in own]]
    return _batch(_ASKS, [*about, [_packed_keys(keys[of]) for _, of in own], *packed])


def _context_sums(of: np.ndarray, contexts: int, n: np.ndarray, seen: np.ndarray, suffix: np.ndarray):
    """Of each context's entries: their occurrences, gain in bits over the suffix, and share by the suffix."""
    plain = n / seen[of]
    gain = plain * np.log2(plain / suffix)
    explicit = np.bincount(of, n, contexts).astype(np.int64)
    return explicit, np.where(explicit > 0, seen, 0), np.bincount(of, gain, contexts), np.bincount(of, suffix, contexts)


def _rests(explicit, seen, gain, share, settings: TreeSettings) -> np.ndarray:
    """The share that a context leaves to its suffix if it is a state, else 1."""
    seen = np.maximum(seen, 1)
    # divergence over the explicit symbols and, as one symbol, all others
    left, left_suffix = np.maximum(1 - explicit / seen, 1e-12), np.maximum(1 - share, 1e-12)
    state = (explicit > 0) & (gain + left * np.log2(left / left_suffix) >= settings.divergence)
    return np.where(state, (seen - explicit + settings.smoothing) / (seen + settings.smoothing), 1.0)


def _answer(asks: pa.Table, settings: TreeSettings) -> pa.RecordBatch:
    """What a bucket has found for each chunk's keys, in their order."""
    kind, bucket = asks["kind"][0].as_py(), asks["bucket"][0].as_py()
    chunks = asks["chunk"].to_pylist()
    keys = [_unpacked_keys(one) for one in asks["keys"].to_pylist()]
    ends = np.cumsum([len(one) for one in keys])
    distinct, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)

    def values(name: str, form: str) -> np.ndarray:
        return np.concatenate([_unpacked(one, form) for one in asks[name].to_pylist()])

    n = np.bincount(inverse, values("n", "<i8")).astype(np.int64)
    if kind in (_STATES, _DEEPER):
        gain, share = (np.bincount(inverse, values(name, "<f8")) for name in ("gain", "share"))
        own = values("seen", "<i8")  # 0 in chunks that own no entry of the context
        seen = np.zeros(len(distinct), np.int64)
        seen[inverse[own > 0]] = own[own > 0]
        found = _rests(n, seen, gain, share, settings)[inverse]
    else:
        found = 2 * n[inverse]
        found[first] += 1  # who owns the key
    facts = [[int(x)] + [0] * (len(chunks) - 1) for x in (n.sum(), (n > 0).sum())]
    packed = [_packed_few(one) for one in np.split(found, ends[:-1])]
    return _batch(_ANSWERS, [[kind] * len(chunks), chunks, [bucket] * len(chunks), packed, *facts])


def score_documents(docs: DataFrame, held_out: Column, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """Scores of all documents by a tree learnt from those for which ``held_out`` is not true.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).
    ``docs`` has doc_id and text; a null text is empty (its only token is the end), and
    repeated rows each get a row. With no training rows all words are unknown; no
    documents give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-tree", shuffles_go=True)
    held = F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))
    chunks = scratch.keep(rows.mapInArrow(_chunks, _CHUNKS), "chunks")
    tokens = chunks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    spread = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, tokens // _BUCKET, min(spread, tokens >> 17))
    size, answers = 1, []  # of the words' shares, once it is known

    def ask(words: bool, step, schema: str) -> DataFrame:
        """``step`` gives batches for each chunk with all answers so far."""
        total_size = size

        def run(own: pa.Table, found: pa.Table) -> pa.Table:
            chunk = _Chunk(own.to_pylist()[0], found, settings, total_size)
            return pa.Table.from_batches(step(chunk))

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    yield from step(_Chunk(batch.slice(row, 1).to_pylist()[0], None, settings))

        if words:
            return chunks.mapInArrow(alone, schema)
        known = reduce(DataFrame.unionAll, answers).groupBy("chunk")
        return chunks.groupBy("chunk").cogroup(known).applyInArrow(run, schema)

    def answered(asks: DataFrame, name: str) -> DataFrame:
        def run(table: pa.Table) -> pa.Table:
            return pa.Table.from_batches([_answer(table, settings)])

        return scratch.keep(asks.groupBy("kind", "bucket").applyInArrow(run, _ANSWERS), name)

    def words_step(chunk: _Chunk) -> list[pa.RecordBatch]:
        counts = np.bincount(chunk.places[chunk.train], minlength=len(chunk.words))
        return [_asks(_WORDS, chunk.id, buckets, chunk.words, counts)]

    def pairs_step(chunk: _Chunk) -> list[pa.RecordBatch]:
        chunk.count_words()
        return [_asks(_PAIRS, chunk.id, buckets, *chunk.meet_pairs())]

    def triples_step(chunk: _Chunk) -> list[pa.RecordBatch]:
        chunk.count_words()
        chunk.meet_pairs()
        chunk.count_pairs()
        own = np.flatnonzero(chunk.pair_owned & chunk.pair_often)
        first, suffix = chunk.first[own], chunk.root[chunk.second[own]]
        sums = _context_sums(first, len(chunk.words), chunk.pair_n[own], chunk.n, suffix)
        states = _asks(_STATES, chunk.id, buckets, *(x[chunk.often] for x in (chunk.words, *sums)))
        return [states, _asks(_TRIPLES, chunk.id, buckets, *chunk.meet_triples())]

    def deeper_step(chunk: _Chunk, half: int) -> list[pa.RecordBatch]:
        chunk.count_words()
        chunk.meet_pairs()
        chunk.count_pairs()
        chunk.enter_pairs()
        chunk.meet_triples()
        chunk.count_triples()
        own = np.flatnonzero(chunk.triple_owned & chunk.triple_often)
        context, suffix = chunk.context[own], chunk.share[chunk.last[own]]
        sums = _context_sums(context, len(chunk.pairs), chunk.triple_n[own], chunk.pair_n, suffix)
        return [_asks(_DEEPER, chunk.id, buckets, *(x[chunk.pair_often] for x in (chunk.pairs, *sums)), half=half)]

    answers.append(answered(ask(True, words_step, _ASKS), "words"))
    facts = answers[0].agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("total", "distinct"))).first()
    total, size = facts["total"], facts["total"] + facts["distinct"] + 1
    for step, name in ((pairs_step, "pairs"), (triples_step, "states")):
        answers.append(answered(ask(False, step, _ASKS), name))
    # one half of the buckets after the other, as all at once would take the most disk of all steps
    halves = [ask(False, partial(deeper_step, half=half), _ASKS) for half in (0, 1)]
    answers += [answered(asks, "deeper-states") for asks in halves]

    def scores_step(chunk: _Chunk) -> list[pa.RecordBatch]:
        chunk.count_words()
        chunk.meet_pairs()
        chunk.count_pairs()
        chunk.enter_pairs()
        chunk.meet_triples()
        chunk.count_triples()
        chunk.enter_triples()
        return [chunk.scores(total)]

    return ask(False, scores_step, _SCORES)
