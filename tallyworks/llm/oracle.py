"""SQL for DuckDB with the rows of those queries that SQL can express."""

from __future__ import annotations

from tallyworks.llm.queries import MIX_WEIGHTS

_WORDS = r"[^\x20\x09-\x0D]+"


def _value(x) -> str:
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)


_WEIGHTS = ", ".join("(" + ", ".join(map(_value, row)) + ")" for row in MIX_WEIGHTS)

MIXING = rf"""
WITH weights(domain, lang, source, w) AS (VALUES {_WEIGHTS}),
d AS (
    SELECT doc_id, lang, source,
        coalesce(['web', 'books', 'forum'][try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,6}})$', 1), '') AS int) % 3 + 1], 'forum') AS domain,
        len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS n_tokens
    FROM documents),
leaf AS (
    SELECT domain, lang, source, sum(n_tokens)::bigint AS tokens,
        coalesce((SELECT w FROM weights x WHERE x.domain = d.domain AND x.lang IS NULL), 1) AS w1,
        coalesce((SELECT w FROM weights x WHERE x.domain = d.domain AND x.lang = d.lang AND x.source IS NULL), 1) AS w2,
        coalesce((SELECT w FROM weights x WHERE x.domain = d.domain AND x.lang = d.lang AND x.source = d.source), 1) AS w3
    FROM d GROUP BY ALL),
l1 AS (SELECT domain, sum(2 * tokens)::hugeint AS cap, max(w1)::hugeint AS w FROM leaf GROUP BY ALL HAVING sum(tokens) > 0),
g0 AS (SELECT least((SELECT sum(tokens) FROM leaf)::bigint * 3 // 5, (SELECT sum(cap) FROM l1))::hugeint AS given),
-- a child takes all it can hold when the level that just fills it is not above its family's level:
-- the family's level is found by filling children up in turn
f1 AS (
    SELECT a.domain, a.cap, a.w, given,
        (SELECT coalesce(sum(least(b.cap, (b.w * a.cap) / a.w::double)), 0) FROM l1 b) <= given AS filled
    FROM l1 a, g0),
a1 AS (
    SELECT domain, CASE WHEN filled THEN cap ELSE
        (given - coalesce((SELECT sum(cap) FROM f1 WHERE filled), 0)) * w // (SELECT sum(w) FROM f1 WHERE NOT filled) END::hugeint AS given
    FROM f1),
l2 AS (SELECT domain, lang, sum(2 * tokens)::hugeint AS cap, max(w2)::hugeint AS w FROM leaf GROUP BY ALL HAVING sum(tokens) > 0),
f2 AS (
    SELECT a.*, g.given,
        (SELECT sum(least(b.cap, (b.w * a.cap) / a.w::double)) FROM l2 b WHERE b.domain = a.domain) <= g.given AS filled
    FROM l2 a JOIN a1 g ON g.domain = a.domain),
a2 AS (
    SELECT domain, lang, CASE WHEN filled THEN cap ELSE
        (given - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY domain), 0)) * w // sum(w) FILTER (NOT filled) OVER (PARTITION BY domain)
        END::hugeint AS given
    FROM f2),
l3 AS (SELECT domain, lang, source, (2 * tokens)::hugeint AS cap, w3::hugeint AS w FROM leaf WHERE tokens > 0),
f3 AS (
    SELECT a.*, g.given,
        (SELECT sum(least(b.cap, (b.w * a.cap) / a.w::double)) FROM l3 b WHERE b.domain = a.domain AND b.lang IS NOT DISTINCT FROM a.lang) <= g.given AS filled
    FROM l3 a JOIN a2 g ON g.domain = a.domain AND g.lang IS NOT DISTINCT FROM a.lang),
a3 AS (
    SELECT domain, lang, source, CASE WHEN filled THEN cap ELSE
        (given - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY domain, lang), 0)) * w // sum(w) FILTER (NOT filled) OVER (PARTITION BY domain, lang)
        END::hugeint AS given
    FROM f3),
p AS (
    SELECT leaf.domain, leaf.lang, leaf.source, tokens,
        CASE WHEN tokens > 0 THEN coalesce(given, 0) // tokens ELSE 0 END::bigint AS epochs,
        CASE WHEN tokens > 0 THEN coalesce(given, 0) % tokens ELSE 0 END::bigint AS rest
    FROM leaf LEFT JOIN a3 ON a3.domain = leaf.domain AND a3.lang IS NOT DISTINCT FROM leaf.lang AND a3.source IS NOT DISTINCT FROM leaf.source),
o AS (
    SELECT d.*, epochs, rest,
        coalesce(sum(n_tokens) OVER (
            PARTITION BY d.domain, d.lang, d.source
            ORDER BY md5('mix:' || epochs || ':' || coalesce(doc_id::varchar, '')), doc_id, n_tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM d JOIN p ON p.domain = d.domain AND p.lang IS NOT DISTINCT FROM d.lang AND p.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, lang, source, domain, n_tokens, epochs, least(n_tokens, greatest(rest - ahead, 0))::bigint AS last_tokens FROM o
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NEAR_COPIES = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORDS}') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM w, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
together AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
    SELECT x, y FROM together JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)),
reach(x, y) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
least_id AS (SELECT x, min(y) AS y FROM reach GROUP BY ALL)
SELECT d.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, l.y AS component_id, l.y = d.doc_id AS kept
FROM documents d JOIN least_id l ON l.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

CAP_JOIN = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::double[] AS e, sqrt(list_inner_product(embedding::double[], embedding::double[])) AS norm
    FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(x, y) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
least_id AS (SELECT x, min(y) AS y FROM reach GROUP BY ALL),
degree AS (SELECT x, count(*) AS n FROM link GROUP BY ALL)
SELECT vec_id, coalesce(n, 0)::bigint AS n_links, l.y AS component_id, l.y = vec_id AS kept
FROM embeddings JOIN least_id l ON l.x = vec_id LEFT JOIN degree ON degree.x = vec_id
"""


def _found(kind: int, pattern: str, value: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT row, kind, end_at - size AS start_at, end_at, value FROM (
        SELECT row, {kind} AS kind, len(m) AS size, {value} AS value,
            sum(len(gap) + len(m)) OVER (PARTITION BY row ORDER BY i) AS end_at
        FROM (SELECT row, unnest(regexp_extract_all(text, '{quoted}')) AS m,
                unnest(string_split_regex(text, '{quoted}')[:len(regexp_extract_all(text, '{quoted}'))]) AS gap,
                unnest(range(len(regexp_extract_all(text, '{quoted}')))) AS i
            FROM d WHERE regexp_matches(text, '{quoted}')))"""


def _secrets() -> str:
    from tallyworks.llm.secret_ownership import ACCESS, ASSIGN, HEX, MIXED

    assign = ASSIGN.replace("'", "''")
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, source, lang FROM documents),
found AS ({_found(0, ASSIGN, f"regexp_extract(m, '{assign}', 2)")} UNION ALL {_found(1, ACCESS, "m")}
    UNION ALL {_found(2, HEX, "m")} UNION ALL {_found(3, MIXED, "m")}),
s AS (
    SELECT f.*, d.source, d.lang FROM found f JOIN d USING (row)
    WHERE CASE kind WHEN 0 THEN len(value) >= 6 WHEN 3 THEN regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') ELSE true END),
o AS (SELECT value, count(DISTINCT coalesce(source, '')) AS owners FROM s GROUP BY ALL),
j AS (SELECT s.*, owners < 3 AS live FROM s JOIN o USING (value)),
kept AS (
    SELECT * FROM j WHERE kind < 3 OR (live AND NOT EXISTS (
        SELECT 1 FROM j b WHERE b.row = j.row AND b.kind < 3 AND b.start_at < j.end_at AND b.end_at > j.start_at))),
named AS (SELECT *, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start_at || ':' || end_at AS span FROM kept)
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    sha256(coalesce(string_agg(span, ',' ORDER BY start_at, kind) FILTER (kind < 3), '')) AS base_sha256,
    coalesce(string_agg(span, ',' ORDER BY start_at, kind), '') AS spans,
    count(*) FILTER (kind = 3) AS n_owned, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
FROM d LEFT JOIN named USING (row) GROUP BY row, doc_id
"""


#: Levels of a tree written out: enough for 8 ** 10 rows of a language and as many languages.
_LEVELS = 10


def _field(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::varchar))::varchar || ':' || {column}::varchar, '-')"


def _row_digest(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _next_level(name: str, below: str) -> str:
    """Nodes of one level: of a tree with more than one node below, each run of eight becomes its digest."""
    return f"""
{name} AS (
    SELECT tree, place // 8 AS place, sha256(string_agg(node, '' ORDER BY place)) AS node FROM {below}
    WHERE tree IN (SELECT tree FROM {below} WHERE place = 1) GROUP BY tree, place // 8
    UNION ALL SELECT tree, place, node FROM {below} WHERE tree NOT IN (SELECT tree FROM {below} WHERE place = 1))"""


def _next_fold(name: str, below: str, nodes: str) -> str:
    """For each leaf the siblings met so far and the node folded with them, one level further up."""
    others = f"string_agg(b.node, '' ORDER BY b.place) FILTER (b.place <> a.place)"
    folded = f"sha256(string_agg(CASE WHEN b.place = a.place THEN a.folded ELSE b.node END, '' ORDER BY b.place))"
    return f"""
{name} AS (
    SELECT a.row, a.tree, a.place // 8 AS place, any_value(a.proof) || coalesce({others}, '') AS proof, {folded} AS folded
    FROM {below} a JOIN {nodes} b ON a.tree = b.tree AND a.place // 8 = b.place // 8
    WHERE a.tree IN (SELECT tree FROM {nodes} WHERE place = 1) GROUP BY a.row, a.tree, a.place
    UNION ALL SELECT * FROM {below} WHERE tree NOT IN (SELECT tree FROM {nodes} WHERE place = 1))"""


def _merkle() -> str:
    lower = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    # DuckDB has no crc32: bit by bit over the digits of doc_id
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::bigint) ELSE c >> 1 END"
    levels = [_next_level(f"n{i + 1}", f"n{i}") for i in range(_LEVELS)]
    folds = [_next_fold(f"f{i + 1}", f"f{i}", f"n{i}") for i in range(_LEVELS)]
    tops = [_next_level(f"t{i + 1}", f"t{i}") for i in range(_LEVELS)]
    top_folds = [_next_fold(f"g{i + 1}", f"g{i}", f"t{i}") for i in range(_LEVELS)]
    body = ",".join
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, * FROM documents),
crc(row, digits, c, bit) AS (
    SELECT row, encode(doc_id::varchar), 4294967295::bigint, 0 FROM d WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT row, digits, {step}, bit + 1 FROM (
        SELECT row, digits, bit, CASE WHEN bit % 8 = 0
            THEN xor(c, ascii(substr(decode(digits), bit // 8 + 1, 1))::bigint) ELSE c END AS c
        FROM crc WHERE bit < 8 * octet_length(digits))),
chosen AS (SELECT row FROM crc WHERE bit = 8 * octet_length(digits) AND xor(c, 4294967295::bigint) % 3 = 0),
leaves AS (SELECT row, doc_id, lang, {_row_digest("text")} AS leaf, {_row_digest(lower)} AS tampered FROM d),
trees AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) AS tree FROM leaves GROUP BY lang),
n0 AS (
    SELECT row, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, leaf AS node,
        CASE WHEN row IN (SELECT row FROM chosen) THEN tampered ELSE leaf END AS folded, doc_id
    FROM leaves JOIN trees ON leaves.lang IS NOT DISTINCT FROM trees.lang),
f0 AS (SELECT row, tree, place, '' AS proof, folded FROM n0),{body(levels)},{body(folds)},
t0 AS (SELECT 0 AS tree, tree - 1 AS place, node FROM n{_LEVELS}),{body(tops)},
g0 AS (SELECT row, 0 AS tree, tree - 1 AS place, proof, folded FROM f{_LEVELS}),{body(top_folds)}
SELECT doc_id, n0.node AS leaf, n{_LEVELS}.node AS subroot, t{_LEVELS}.node AS root, sha256(proof) AS proof_sha256,
    g.folded AS folded_root, g.folded = t{_LEVELS}.node AS verified
FROM n0 JOIN n{_LEVELS} ON n{_LEVELS}.tree = n0.tree JOIN g{_LEVELS} g ON g.row = n0.row, t{_LEVELS}
"""


def _audit() -> str:
    from itertools import permutations

    from tallyworks.llm.filter_audit import LETTERS

    orders = ", ".join(f"('{''.join(order)}')" for order in permutations(LETTERS))
    fails = " ".join(f"WHEN '{letter}' THEN {letter.lower()}" for letter in LETTERS)
    return f"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w
    FROM documents),
firsts AS (SELECT coalesce(text, '') AS text, min(doc_id) AS first_id FROM documents GROUP BY ALL),
judged AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY ALL),
failing AS (
    SELECT row_number() OVER () AS row, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
        100 * len(regexp_replace(words.text, '[^A-Z]', '', 'g')) > 5 * len(words.text) AS c,
        regexp_matches(words.text, '[#$%&*|]') AS d, coalesce(first_id < words.doc_id, false) AS e,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM words JOIN firsts ON words.text = firsts.text LEFT JOIN judged ON words.doc_id = judged.doc_id),
sets AS (
    SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
    FROM failing GROUP BY ALL),
turns AS (
    SELECT filter_order, step::int AS step, filter_order[step] AS letter, filter_order[:step - 1] AS before
    FROM (VALUES {orders}) AS o(filter_order), range(1, 6) AS s(step)),
met AS (
    SELECT part, filter_order, step, letter, n, n_good, n_toxic, CASE letter {fails} END AS fails,
        a::int + b::int + c::int + d::int + e::int AS n_fails,
        (a AND contains(before, 'A')) OR (b AND contains(before, 'B')) OR (c AND contains(before, 'C'))
            OR (d AND contains(before, 'D')) OR (e AND contains(before, 'E')) AS gone
    FROM sets, turns),
steps AS (
    SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::bigint AS kept,
        coalesce(sum(n) FILTER (NOT gone AND fails), 0)::bigint AS removed,
        coalesce(sum(n) FILTER (gone AND fails), 0)::bigint AS redundant,
        coalesce(sum(n) FILTER (fails AND n_fails = 1), 0)::bigint AS unique_fails,
        coalesce(sum(n_good) FILTER (NOT gone AND fails), 0)::bigint AS good_lost,
        coalesce(sum(n_toxic) FILTER (NOT gone AND fails), 0)::bigint AS toxic_lost
    FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::bigint AS shapley
FROM steps
"""


TOP_PRODUCTS = """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.row, a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.e, b.e)::bigint AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.row <> b.row AND len(a.e) = len(b.e))
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, (row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id))::int AS rank FROM scored)
WHERE rank <= 5
"""


ORACLE = {
    "op2_source_mixing": MIXING,
    "op3_cap_join": CAP_JOIN,
    "op8_forest_dedup": NEAR_COPIES,
    "op9_secret_ownership": _secrets(),
    "op11_merkle_manifest": _merkle(),
    "op12_filter_audit": _audit(),
    "op13_pivot_topk": TOP_PRODUCTS,
}
