"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def removed_repeats(docs, width=400):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the rest) of (doc_id, text) rows."""
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(t[i : i + width] for _, t in data for i in range(len(t) - width + 1))
    out = []
    for d, t in data:
        cover = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                cover[i : i + width] = True
        rest = bytes(b for b, gone in zip(t, cover) if not gone)
        spans = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        out.append((d, len(t), int(cover.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def shingles(text: str | None) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def near_copies(docs, percent=85):
    """(doc_id, n_shingles, component_id, kept)."""
    sets = {d: shingles(t) for d, t in docs}
    index = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            index[x].append(d)
    shared = Counter()
    for ids in index.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    comp = components(sets, links)
    return [(d, len(sets[d]), comp[d], comp[d] == d) for d, _ in docs]


def vector_links(rows, bound=0.98):
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding, label) rows."""
    groups = defaultdict(list)
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        groups[label, len(v)].append((i, np.array(v, np.float64)))
    count, links = Counter(), []
    for some in groups.values():
        x = np.stack([v for _, v in some])
        x = x / np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ids = [i for i, _ in some]
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= bound, 1))):
            links.append((ids[a], ids[b]))
            count[ids[a]] += 1
            count[ids[b]] += 1
    comp = components([r[0] for r in rows], links)
    return [(i, count[i], comp[i], comp[i] == i) for i, _, _ in rows]


def base_scores(docs, held_out):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    train = Counter()
    for d, t in docs:
        if not held_out(d):
            train.update(words(t))
            train[None] += 1
    total, distinct = sum(train.values()), len(train)
    out = []
    for d, t in docs:
        tokens = [*words(t), None]
        score = sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in tokens)
        out.append((d, held_out(d), len(tokens), sum(train[w] > 0 for w in tokens), total, score))
    return out


def tree_scores(docs, held_out, least=2, divergence=0.02, smoothing=2.0):
    """(doc_id, score) by a suffix tree of contexts of one and two words, all in dictionaries."""
    counts = [Counter(), Counter(), Counter()]
    symbols = [(d, [*words(t), None]) for d, t in docs]
    for d, own in symbols:
        if not held_out(d):
            for n in range(3):
                counts[n].update(tuple(own[i : i + n + 1]) for i in range(len(own) - n))
    size = sum(counts[0].values()) + len(counts[0]) + 1
    states = {}

    def share(context, symbol):
        if not context:
            return (counts[0][(symbol,)] + 1) / size
        entry, rest = states.get(context, ({}, 1.0))
        return entry.get(symbol, 0.0) + rest * share(context[1:], symbol)

    for n in (1, 2):
        following = defaultdict(dict)
        for gram, c in counts[n].items():
            if c >= least:
                following[gram[:-1]][gram[-1]] = c
        found = {}
        for context, entries in following.items():
            seen, explicit = counts[n - 1][context], sum(entries.values())
            below = {x: share(context[1:], x) for x in entries}
            gain = sum(c / seen * math.log2(c / seen / below[x]) for x, c in entries.items())
            left, left_below = max(1 - explicit / seen, 1e-12), max(1 - sum(below.values()), 1e-12)
            if gain + left * math.log2(left / left_below) >= divergence:
                shares = {x: c / (seen + smoothing) for x, c in entries.items()}
                found[context] = shares, (seen - explicit + smoothing) / (seen + smoothing)
        states.update(found)
    return [(d, sum(math.log10(share(tuple(own[max(i - 2, 0) : i]), w)) for i, w in enumerate(own))) for d, own in symbols]


def remainder(doc_id, divisor: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


def _digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def merkle(rows: list[dict], fan: int = 8) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows of documents."""

    def leaf(row):
        return _digest(*[_field(row[name]) for name in ("doc_id", "source", "lang", "n_chars", "text")])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([_digest(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
        return levels

    def path(levels, i):
        for level in levels[:-1]:
            start = i // fan * fan
            yield "".join(level[start:i]), "".join(level[i + 1 : start + fan])
            i //= fan

    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), row))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        groups[lang].sort(key=lambda x: x[:3])
    trees = {lang: tree([x[2] for x in groups[lang]]) for lang in order}
    top = tree([trees[lang][-1][0] for lang in order]) if order else []
    out = []
    for g, lang in enumerate(order):
        for i, (_, _, own, row) in enumerate(groups[lang]):
            steps, node, doc_id = [*path(trees[lang], i), *path(top, g)], own, row["doc_id"]
            if doc_id is not None and row["text"] is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
                node = leaf({**row, "text": lowered})
            for left, right in steps:
                node = _digest(left, node, right)
            root = top[-1][0]
            proof = _digest(*[left + right for left, right in steps])
            out.append((doc_id, own, trees[lang][-1][0], root, proof, node, node == root))
    return out


def audit(docs: list[dict], labels: list[dict]) -> list[tuple]:
    """Rows of the filter audit, every order run on its own."""
    good = {row["doc_id"] for row in labels if row["quality"] == 1}
    toxic = {row["doc_id"] for row in labels if row["toxic"] == 1}
    first: dict[str, int] = {}
    for row in docs:
        if row["doc_id"] is not None:
            text = row["text"] or ""
            first[text] = min(first.get(text, row["doc_id"]), row["doc_id"])
    parts = defaultdict(list)
    for row in docs:
        text, doc_id = row["text"] or "", row["doc_id"]
        found = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = {
            "A": len(found) < 50,
            "B": 100 * len(set(found)) < 65 * len(found),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and first[text] < doc_id if text in first else False,
        }
        parts[row["source"] or ""].append((frozenset(k for k, v in fails.items() if v), doc_id in good, doc_id in toxic))
    out = []
    for part, rows in parts.items():
        share, steps = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left, gone = rows, []
            for step, letter in enumerate(order, 1):
                removed = [row for row in left if letter in row[0]]
                redundant = sum(letter in row[0] for row in gone)
                left = [row for row in left if letter not in row[0]]
                gone = gone + removed
                share[letter] += len(removed)
                alone = sum(row[0] == {letter} for row in rows)
                lost = [sum(row[i] for row in removed) for i in (1, 2)]
                steps.append((letter, (part, "".join(order), step, len(left), len(removed), redundant, alone, *lost)))
        out += [(*step, share[letter]) for letter, step in steps]
    return out


def top_products(rows: list[tuple], k: int = 5, width: int = 256) -> list[tuple]:
    """(query_id, rank, vec_id, score) of (vec_id, vector) rows."""
    usable = [
        (i, v, [math.floor(width * c) for c in x])
        for i, (v, x) in enumerate(rows)
        if v is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)
    ]
    out = []
    for i, v, x in usable:
        if v % 50 == 0:
            scored = [(-sum(map(int.__mul__, x, y)), w) for j, w, y in usable if j != i and len(x) == len(y)]
            out += [(v, rank, w, -score) for rank, (score, w) in enumerate(sorted(scored)[:k], 1)]
    return out
