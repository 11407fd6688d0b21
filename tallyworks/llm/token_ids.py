"""Token ids of texts by a public tokenizer's file, with a memory for repeated words."""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, compress, groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WORDS_A_TEXT = 40
_SPACE = "\u0120"  # what byte-level tokens have for a space
_LOADED: dict[str, WordMemory] = {}
#: A space that may not begin a word: at the end, or before anything but letters, marks, numbers and signs.
_ODD_SPACE = r" (?:[^\pL\pM\pN\pP\pS]|$)"
_WORD_START = re.compile(r"(?= \S)")


class WordMemory:
    """Encodes texts word by word; equal words are encoded once.

    A byte-level tokenizer with its usual pattern splits a text before each space that a
    non-space follows and never joins across, so a text's ids are those of its words, each with
    the space in front of it. Any other kind of tokenizer is given whole texts.

    New words go to the tokenizer many at a time, as one text. Each word's first id is one that
    begins with a space; where other ids do too, the tokenizer's offsets tell which are whose. Of
    the words known, the ``limit`` newest at least are kept, as far as they have no more than 64
    bytes each on average. They lie in Arrow and numpy arrays, one after the other: an object for
    each word took ten times the memory. ``ids`` are little-endian 32-bit values.
    """

    def __init__(self, path: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        self._by_word = _cut_at_spaces(kind)
        vocabulary = self._tokenizer.get_vocab()
        self._spaced = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self._spaced[[code for token, code in vocabulary.items() if token.startswith(_SPACE)]] = True
        self._limit = limit
        self._known = pa.array([], pa.large_string())
        self._ids, self._ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)  # of the known words, in their order

    @property
    def vocabulary(self) -> int:
        return self._tokenizer.get_vocab_size()

    def ids(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not self._by_word:
            encoded = self._tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
            return [np.array(one.ids, "<u4").tobytes() for one in encoded]
        # millions of small objects and no cycles: the collector would look them over in vain
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._by_words(texts)
        finally:
            if collecting:
                gc.enable()
            # else Arrow keeps several times what the known words take
            pa.default_memory_pool().release_unused()

    def _by_words(self, texts: pa.Array) -> list[bytes]:
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        places = np.flatnonzero(odd)
        if not len(places):
            return self._regular(texts)
        out: list[bytes] = [b""] * len(texts)
        plain = np.flatnonzero(~odd)
        for place, ids in zip(plain.tolist(), self._regular(texts.take(pa.array(plain)))):
            out[place] = ids
        split = [[word for word in _WORD_START.split(text) if word] for text in texts.take(pa.array(places)).to_pylist()]
        words = list(set().union(*split))
        places_of = self._places(pa.array(words, pa.large_string())).tolist()
        data, ends = memoryview(self._ids).cast("B"), self._ends
        known = {word: data[4 * ends[at] : 4 * ends[at + 1]] for word, at in zip(words, places_of)}
        for place, own in zip(places.tolist(), split):
            out[place] = b"".join(map(known.__getitem__, own))
        return out

    def _regular(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts whose every space begins a word: all words at once, their ids gathered by place."""
        if not len(texts):
            return []
        pieces = pc.split_pattern(texts, " ")
        cuts = pieces.offsets.to_numpy()
        flat, first = pieces.flatten(), np.zeros(cuts[-1] - cuts[0], bool)
        cuts = cuts - cuts[0]
        first[cuts[:-1]] = True
        begins = flat.filter(pa.array(first)).dictionary_encode()
        others = flat.filter(pa.array(~first)).dictionary_encode()
        spaced = pc.binary_replace_slice(others.dictionary.cast(pa.large_string()), 0, 0, " ")
        known = self._places(pa.concat_arrays([spaced, begins.dictionary.cast(pa.large_string())]))
        place = np.empty(len(flat), np.int64)
        place[~first] = known[: len(spaced)][others.indices.to_numpy()]
        place[first] = known[len(spaced) :][begins.indices.to_numpy()]
        starts = self._ends[place]
        lengths = self._ends[place + 1] - starts
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1])
        at += np.repeat(starts - ends + lengths, lengths)
        ids = self._ids[at].tobytes()
        bounds = (4 * np.concatenate([[0], ends])[cuts]).tolist()
        return [ids[start:end] for start, end in zip(bounds, bounds[1:])]

    def _places(self, words: pa.Array) -> np.ndarray:
        """Places of different words among the known ones, after the new ones have been learnt."""
        self._forget()
        out = np.full(len(words), -1, np.int64)
        # the few words are looked up by the many: a table of the many would take long to build
        found = pc.index_in(self._known, value_set=words)
        met = found.is_valid().to_numpy(zero_copy_only=False)
        out[found.drop_null().to_numpy()] = np.flatnonzero(met)
        missing = np.flatnonzero(out < 0)
        out[missing] = len(self._known) + np.arange(len(missing))
        new = words.take(pa.array(missing))
        learnt, sizes = [self._ids], [np.diff(self._ends)]
        for at in range(0, len(new), 20_000):
            for ids, lengths in self._learn(new.slice(at, 20_000).to_pylist()):
                learnt.append(ids)
                sizes.append(lengths)
        if len(new):
            self._known = pa.concat_arrays([self._known, new])
            self._ids = np.concatenate(learnt)
            self._ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return out

    def _forget(self) -> None:
        """Keep the newest words only when there are more than twice the limit, or they are long."""
        keep, most = len(self._known), 64 * self._limit
        if keep > 2 * self._limit:
            keep = self._limit
        while keep and self._known.slice(len(self._known) - keep).nbytes + 4 * (len(self._ids) - self._ends[-1 - keep]) > 2 * most:
            keep //= 2
        if keep < len(self._known):
            self._known = pa.concat_arrays([self._known.slice(len(self._known) - keep)])
            begin = self._ends[-1 - keep]
            self._ids, self._ends = self._ids[begin:].copy(), self._ends[-1 - keep :] - begin

    def _learn(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of words one after the other, and how many each has."""
        # a text's first word has no space in front that would keep it apart from the one before
        spaced = [word[:1] == " " for word in words]
        rest = list(compress(words, spaced))
        first = [word for word, one in zip(words, spaced) if not one]
        # long texts cost the tokenizer more a word than texts of some words
        texts = ["".join(rest[at : at + _WORDS_A_TEXT]) for at in range(0, len(rest), _WORDS_A_TEXT)]
        own = [code.ids for code in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(own), "<u4", sum(map(len, own)))
        cuts = np.flatnonzero(self._spaced[ids])
        # a word begins with a space, so it has one such id at least: as many as words are one each
        if len(cuts) == len(rest):
            cuts = np.append(cuts[1:], len(ids))[: len(rest)]
        else:
            cuts = self._cuts(texts, rest)
        sizes = np.diff(cuts, prepend=0)
        if not first:
            yield ids, sizes
            return
        single = [code.ids for code in self._tokenizer.encode_batch(first, add_special_tokens=False)]
        # the words' own order: runs of spaced words between single ones
        begin, ends, lone = 0, np.cumsum(sizes), iter(single)
        done = 0
        for one, run in groupby(spaced):
            n = sum(1 for _ in run)
            if one:
                end = int(ends[done + n - 1])
                yield ids[begin:end], sizes[done : done + n]
                begin, done = end, done + n
            else:
                some = list(islice(lone, n))
                yield np.fromiter(chain.from_iterable(some), "<u4"), np.fromiter(map(len, some), np.int64, n)

    def _cuts(self, texts: list[str], words: list[str]) -> np.ndarray:
        """Where the ids of each word end, by the tokenizer's offsets; ``texts`` are the words joined."""
        codes = self._tokenizer.encode_batch(texts, add_special_tokens=False)
        places = np.array(list(chain.from_iterable(code.offsets for code in codes)), np.int64).reshape(-1, 2)
        # offsets leave out blanks: a token of nothing else ends where it begins
        inside = places[:, 0] - (places[:, 0] == places[:, 1])
        before = np.cumsum([0] + [len(text) for text in texts])[:-1]
        inside += np.repeat(before, [len(code) for code in codes])
        return np.searchsorted(inside, np.cumsum([len(word) for word in words]))


def _cut_at_spaces(kind: dict) -> bool:
    """Whether a tokenizer's file asks for the byte-level pattern alone."""
    cutter = kind.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    # an added token with a space inside, or one that takes spaces beside it, could reach over two words
    added = kind.get("added_tokens", [])
    return plain and not kind.get("normalizer") and not any(
        " " in token["content"] or token.get("lstrip") or token.get("rstrip") for token in added
    )


def word_memory(path: str) -> WordMemory:
    """The memory of this Python worker for the tokenizer file at ``path``."""
    if path not in _LOADED:
        _LOADED[path] = WordMemory(path)
    return _LOADED[path]
