"""Removal of long repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first ``width`` bytes, by passes over digits, the
most significant first; a suffix alone in its group leaves the sort, and the groups
that are left after the last digit are exactly the repeated windows.

The first digit is the window's least k-gram (by hash, leftmost of equals). Neighbouring
windows share it, so a run of them travels as one segment, and segments whose digit
occurs once in the corpus never move. Equal segments are counted, not compared. Segments
of one digit are then sorted together in a task; where too many differ, the digit is made
wider first: half of the bytes that are missing to the left or to the right of it, until
the crowd has parted or the digit is the whole window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.scratch import Scratch
from tallyworks.llm.words import mix, parts, text_bytes

_U = np.uint64
_BASE = 0x100000001B3
_PLACE_BITS = 20


@dataclass(frozen=True)
class RepeatSettings:
    width: int = 400  # bytes of a repeated string
    gram: int = 64  # bytes of the first digit, a power of two
    digit: int = 50  # bytes of a later digit; width is a multiple of it
    crowd: int = 256  # different segments of one digit that are sorted in one task


def _rolled(data: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of the ``size`` bytes from each place, by doubling."""
    out, have = None, 0
    power, power_size = data.astype(np.uint64) + _U(1), 1
    with np.errstate(over="ignore"):
        while True:
            if size & power_size:
                n = len(power) - have
                if out is None:
                    out = power
                else:
                    shift = _U(pow(_BASE, power_size, 1 << 64))
                    n = len(data) - have - power_size + 1
                    out = out[:n] * shift + power[have : have + n]
                have += power_size
            if have == size:
                return out
            shift = _U(pow(_BASE, power_size, 1 << 64))
            power = power[:-power_size] * shift + power[power_size:]
            power_size *= 2


def _segments(data: np.ndarray, owner_end: np.ndarray, settings: RepeatSettings):
    """Runs of windows with the same first digit: place, windows, digit, place of the digit.

    ``owner_end`` is, for each place, the end of the row it belongs to.
    """
    step = 1 << (_PLACE_BITS - 1)
    span = settings.width - settings.gram + 1
    out: list[list[np.ndarray]] = [[], [], [], []]
    for begin in range(0, max(len(data) - settings.width + 1, 0), step):
        part = data[begin : begin + step + settings.width - 1]
        windows = len(part) - settings.width + 1
        valid = np.arange(begin, begin + windows) + settings.width <= owner_end[begin : begin + windows]
        if not valid.any():
            continue
        grams = mix(_rolled(part, settings.gram))
        # hash above, place below: the least is the leftmost of the least hashes
        marked = (grams >> _U(_PLACE_BITS) << _U(_PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
        padded = np.full(-(-len(marked) // span) * span, ~_U(0))
        padded[: len(marked)] = marked
        table = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(table, axis=1).ravel()
        behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
        place = (least & _U((1 << _PLACE_BITS) - 1)).astype(np.int64)
        place[~valid] = -1
        cuts = np.flatnonzero(np.diff(place)) + 1
        starts = np.concatenate([[0], cuts])
        sizes = np.diff(np.concatenate([starts, [windows]]))
        real = place[starts] >= 0
        starts, sizes = starts[real], sizes[real]
        anchor = place[starts]
        for held, values in zip(out, (starts + begin, sizes, grams[anchor].view(np.int64), anchor + begin)):
            held.append(values)
    return [np.concatenate(v) if v else np.zeros(0, np.int64) for v in out]


def _digest(text: bytes) -> tuple[int, int]:
    raw = hashlib.blake2b(text, digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _all_segments(settings: RepeatSettings):
    """Task function: the segments of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text", 2 << 20):
                data, offsets = text_bytes(batch.column("text"))
                if not len(data):
                    continue
                lengths = np.diff(offsets)
                starts, sizes, digit, anchor = _segments(data, np.repeat(offsets[1:], lengths), settings)
                row = np.searchsorted(offsets, starts, "right") - 1
                view = memoryview(np.ascontiguousarray(data)).cast("B")
                digests = [_digest(view[a : a + n + settings.width - 1]) for a, n in zip(starts.tolist(), sizes.tolist())]
                first, second = (np.array(v, np.int64) for v in zip(*digests)) if digests else (np.zeros(0, np.int64),) * 2
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(pa.array(row)),
                        pa.array(starts - offsets[row]),
                        pa.array(sizes.astype(np.int64)),
                        pa.array((anchor - starts).astype(np.int64)),
                        pa.array(digit),
                        pa.array(first),
                        pa.array(second),
                    ],
                    ["row", "start", "windows", "at", "core", "hash_a", "hash_b"],
                )

    return run


def _cut_out(settings: RepeatSettings):
    """Task function: the bytes of the listed segments of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "start", "windows", "at", "core", "hash_a", "hash_b", "n"]
        for whole in batches:
            for batch in parts(whole, "text"):
                out: list[list] = [[] for _ in range(len(names) + 1)]
                texts = batch.column("text").cast(pa.large_binary())
                for k, segments in enumerate(batch.column("segments").to_pylist()):
                    view = memoryview(texts[k].as_buffer())
                    row = batch.column("row")[k].as_py()
                    for s in segments:
                        values = [row, *[s[name] for name in names[1:]]]
                        values.append(bytes(view[s["start"] : s["start"] + s["windows"] + settings.width - 1]))
                        for held, value in zip(out, values):
                            held.append(value)
                types = [pa.int64()] * len(names) + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], [*names, "piece"])

    return run


def _merged(places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unions of [p, p + width) over ascending places."""
    first = np.ones(len(places), bool)
    first[1:] = places[1:] > places[:-1] + width
    last = np.ones(len(places), bool)
    last[:-1] = first[1:]
    return places[first], places[last] + width


def _sorted_out(cores, ats, sizes, pieces, settings: RepeatSettings) -> np.ndarray:
    """Places, in the joined pieces, of windows that occur more than once under one digit."""
    width, digit = settings.width, settings.digit
    data = np.frombuffer(b"".join(pieces), np.uint8)
    firsts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
    places = np.concatenate([np.arange(a, a + n) for a, n in zip(firsts, sizes)])
    # windows of one digit are equal only if it lies at the same place in them
    within = np.concatenate([np.arange(n) for n in sizes])
    group = mix(np.repeat(cores, sizes).view(np.uint64) ^ mix((np.repeat(ats, sizes) - within).astype(np.uint64)))
    digits = _rolled(data, digit)
    for depth in range(0, width + digit, digit):
        _, of, counts = np.unique(group, return_inverse=True, return_counts=True)
        shared = counts[of] > 1
        places, of = places[shared], of[shared]
        if not len(places) or depth == width:
            break
        group = mix(mix(of.astype(np.uint64)) + digits[places + depth])
    if not len(places):
        return places
    # digits were numbered by hash: each group is compared with its first window, byte by byte
    order = np.argsort(of, kind="stable")
    places, of = places[order], of[order]
    leader = places[np.searchsorted(of, of)]
    spans = np.lib.stride_tricks.sliding_window_view(data, width)
    equal = np.concatenate(
        [(spans[places[a : a + 10_000]] == spans[leader[a : a + 10_000]]).all(1) for a in range(0, len(places), 10_000)]
    )
    mates = np.bincount(of, equal, int(of.max()) + 1) > 1
    good = equal & mates[of]
    odd = np.flatnonzero(~equal)
    if len(odd):  # equal hashes of different bytes
        seen: dict[bytes, list[int]] = {}
        for k in odd:
            seen.setdefault(spans[places[k]].tobytes(), []).append(k)
        for some in seen.values():
            good[some] = len(some) > 1
    return np.sort(places[good])


def _repeats_in_task(settings: RepeatSettings):
    """Task function over segments sorted by digit: covered bytes (row, begin, end)."""

    def block(rows: list[tuple]):
        cores = np.array([r[4] for r in rows], np.int64)
        sizes = np.array([r[2] for r in rows], np.int64)
        ats = np.array([r[3] for r in rows], np.int64)
        pieces = [r[6] for r in rows]
        places = _sorted_out(cores, ats, sizes, pieces, settings)
        firsts = np.cumsum([0] + [len(p) for p in pieces])
        out: list[tuple] = []
        cuts = np.searchsorted(places, firsts)
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a and rows[k][5] == 1:  # the others are covered already
                shift = rows[k][1] - firsts[k]
                for begin, end in zip(*_merged(places[a:b], settings.width)):
                    out.append((rows[k][0], int(begin + shift), int(end + shift)))
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            names = ("row", "start", "windows", "at", "core", "n", "piece")
            for row in zip(*[batch.column(name).to_pylist() for name in names]):
                if held and size >= 1 << 20 and row[4] != held[-1][4]:
                    yield block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield block(held)

    return run


def _widened(settings: RepeatSettings, core_size: int, level: int):
    """Task function: each segment parted in two, with a wider digit for each part."""
    missing = settings.width - core_size
    left = -(-missing // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "start", "windows", "at", "core", "hash_a", "hash_b", "n", "piece"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for row, start, windows, at, core, n, piece in zip(
                *[batch.column(c).to_pylist() for c in ("row", "start", "windows", "at", "core", "n", "piece")]
            ):
                turn = min(max(at - left + 1, 0), windows)  # windows before it reach far to the left
                for side, (a, b) in enumerate(((0, turn), (turn, windows))):
                    if a == b:
                        continue
                    own = piece[a : b + settings.width - 1]
                    new_at = (at - left if side == 0 else at) - a
                    size = core_size + (left if side == 0 else missing - left + 1)
                    size = min(size, settings.width)
                    digit = _digest(b"%d %d " % (level, side) + own[new_at : new_at + size])[0]
                    digest = _digest(b"%d " % new_at + own)
                    for held, value in zip(out, (row, start + a, b - a, new_at, digit, *digest, n, own)):
                        held.append(value)
            types = [pa.int64()] * 8 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names)

    return run


_PIECES = "row long, start long, windows long, at long, core long, hash_a long, hash_b long, n long, piece binary"
_SPANS = "row long, begin long, end long"


def repeated_spans(texts: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """Bytes covered by strings of ``width`` bytes that start more than once: (row, begin, end).

    ``texts`` has row (long; rows of one number hold one text) and text. Spans of a row may
    overlap. Texts shorter than ``width`` and nulls have none.
    """
    scratch = Scratch(texts.sparkSession, "suffixes")
    identity = ["core", "hash_a", "hash_b"]
    found = scratch.keep(
        texts.mapInArrow(
            _all_segments(settings),
            "row long, start long, windows long, at long, core long, hash_a long, hash_b long",
        ),
        "segments",
    )
    alive = found.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    segments = scratch.keep(found.join(alive, "core"), "alive")
    first = F.min(F.struct("row", "start", "windows", "at"))
    distinct = scratch.keep(
        segments.groupBy(*identity).agg(F.count("*").alias("n"), first.alias("first")).select(*identity, "n", "first.*"),
        "distinct",
    )
    whole = F.col("windows") + (settings.width - 1)
    copied = segments.join(distinct.where("n > 1").select(*identity), identity, "left_semi")
    spans = [scratch.keep(copied.select("row", F.col("start").alias("begin"), (F.col("start") + whole).alias("end")), "copied")]
    scratch.drop(found)

    varied = distinct.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
    listed = (
        distinct.join(varied, "core")
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "windows", "at", *identity, "n")).alias("segments"))
    )
    # a row number names one text, so any of its rows will do
    pieces = texts.dropDuplicates(["row"]) if _repeats(texts) else texts
    pieces = scratch.keep(pieces.join(listed, "row").mapInArrow(_cut_out(settings), _PIECES), "pieces")
    core_size, level = settings.gram, 0
    while True:
        kinds = pieces.groupBy("core").agg(F.count("*").alias("kinds"))
        few = pieces.join(kinds.where((F.col("kinds") > 1) & (F.col("kinds") <= settings.crowd)).select("core"), "core")
        names = ("row", "start", "windows", "at", "core", "n", "piece")
        spans.append(
            scratch.keep(
                few.select(*names).repartition("core").sortWithinPartitions("core").mapInArrow(_repeats_in_task(settings), _SPANS),
                f"spans-{level}",
            )
        )
        crowded = kinds.where(F.col("kinds") > settings.crowd).select("core")
        if core_size >= settings.width or crowded.isEmpty():
            break
        level += 1
        parted = scratch.keep(
            pieces.join(crowded, "core", "left_semi").mapInArrow(_widened(settings, core_size, level), _PIECES), f"parted-{level}"
        )
        missing = settings.width - core_size
        core_size += min(-(-missing // 2), missing - -(-missing // 2) + 1)
        # parts that have become equal: all are covered, one of them stays for comparison
        same = parted.groupBy(*identity).agg(F.count("*").alias("copies"), F.sum("n").alias("n"), F.min(F.struct("row", "start")).alias("first"))
        many = parted.join(same.where("copies > 1").select(*identity), identity, "left_semi").where("n = 1")
        spans.append(
            scratch.keep(many.select("row", F.col("start").alias("begin"), (F.col("start") + whole).alias("end")), f"equal-{level}")
        )
        kept = parted.drop("n").join(same.select(*identity, "n", "first"), identity).where(
            (F.col("row") == F.col("first.row")) & (F.col("start") == F.col("first.start"))
        )
        scratch.drop(pieces)
        pieces = scratch.keep(kept.select(*[part.split()[0] for part in _PIECES.split(", ")]), f"pieces-{level}")
    out = spans[0]
    for more in spans[1:]:
        out = out.union(more)
    return out


def _repeats(texts: DataFrame) -> bool:
    """Whether a row number occurs more than once."""
    return not texts.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def _kept(settings: RepeatSettings, with_text: bool):
    """Task function: lengths, spans and what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text"):
                texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
                out: list[list] = [[], [], [], [], []]
                for k, spans in enumerate(batch.column("spans").to_pylist()):
                    text = texts[k].as_py()
                    merged: list[list[int]] = []
                    for span in sorted((s["begin"], s["end"]) for s in spans or ()):
                        if merged and span[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], span[1])
                        else:
                            merged.append(list(span))
                    at, left = 0, []
                    for begin, end in merged:
                        left.append(text[at:begin])
                        at = end
                    left = b"".join([*left, text[at:]])
                    values = (len(text), len(text) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left)
                    for held, value in zip(out, values):
                        held.append(value)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
                n = 5 if with_text else 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[pa.array(v, t) for v, t in zip(out[:n], types)]], ["doc_id", *names[:n]]
                )

    return run


def remove_repeats(docs: DataFrame, settings: RepeatSettings = RepeatSettings(), with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every document, whole texts as UTF-8.

    A byte goes if a string of ``width`` bytes over it starts anywhere else too, in the same
    document or another; repeated rows are repeats of each other. ``docs`` has doc_id and text;
    a null text is empty, a null doc_id stays null, other columns are not read, and no rows give
    no rows. ``with_text`` adds what is left as kept_text (bytes: a cut may part a character).
    """
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    spans = repeated_spans(texts.select("row", "text"), settings)
    # as many spans as the document has segments at most
    gathered = spans.distinct().groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text binary" if with_text else "")
    return texts.join(gathered, "row", "left").drop("row").mapInArrow(_kept(settings, with_text), schema)
