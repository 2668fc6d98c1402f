"""SQL counterparts (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

_WORDS = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '')"
)

NEAR_DUPLICATES = f"""
WITH RECURSIVE
worded AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
    ELSE [] END AS s
  FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS v FROM sets),
links AS (
  SELECT a.doc_id AS one, b.doc_id AS other
  FROM shingles a JOIN shingles b ON a.v = b.v AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (
  SELECT doc_id, doc_id AS found FROM sets
  UNION
  SELECT r.doc_id, l.other FROM reached r JOIN links l ON r.found = l.one)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(r.found) AS component_id,
  s.doc_id = min(r.found) AS kept
FROM sets s JOIN reached r ON r.doc_id = s.doc_id
GROUP BY s.doc_id
"""

# Five hexadecimal digits of the digest at a time are four of base32.
_BASE32 = (
    "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)), '')"
)

ARCHIVED_PAGES = f"""
WITH payloads AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY h, payload_bytes ORDER BY page_id DESC NULLS LAST) AS place,
    max(page_id) OVER (PARTITION BY h, payload_bytes) AS largest
  FROM payloads)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN largest END AS refers_to
FROM placed
"""


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

RANKED_ITEMS = f"""
WITH worded AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
sized AS (SELECT doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM worded WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM held, whole GROUP BY term),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM wanted JOIN held USING (term) JOIN weighed USING (term), whole GROUP BY item_id, doc_id),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 50
"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(name) for name in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# CRC-32 of the decimal doc_id, bit by bit.
_CRC32 = (
    "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    "lambda c: CAST(ord(c) AS BIGINT))), lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], "
    "[CAST(0 AS BIGINT) FOR _ IN range(8)]), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)

MERKLE_PROOFS = f"""
WITH RECURSIVE
own AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
    CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS given
  FROM documents),
ranked AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM own)),
placed AS (
  SELECT o.*, r.tree, row_number() OVER (PARTITION BY r.tree ORDER BY o.doc_id NULLS FIRST, o.leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY r.tree) AS n
  FROM own o JOIN ranked r ON o.lang IS NOT DISTINCT FROM r.lang),
low AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY tree, level, pos // 2, n),
high AS (
  SELECT CAST(-1 AS BIGINT) AS tree, 0 AS level, tree AS pos, (SELECT count(*) FROM ranked) AS n, digest FROM low WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY tree, level, pos // 2, n),
nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
climb AS (
  SELECT doc_id, leaf, tree AS home, tree, 0 AS level, pos, n, given AS folded, '' AS met FROM placed
  UNION ALL
  SELECT c.doc_id, c.leaf, c.home,
    CASE WHEN c.n = 1 THEN -1 ELSE c.tree END,
    CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.n = 1 THEN c.home ELSE c.pos // 2 END,
    CASE WHEN c.n = 1 THEN (SELECT count(*) FROM ranked) ELSE (c.n + 1) // 2 END,
    CASE WHEN c.n = 1 THEN c.folded WHEN c.pos % 2 = 0 THEN sha256(c.folded || coalesce(s.digest, '')) ELSE sha256(s.digest || c.folded) END,
    c.met || CASE WHEN c.n = 1 THEN '' ELSE coalesce(s.digest, '') END
  FROM climb c LEFT JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)
  WHERE NOT (c.tree = -1 AND c.n = 1))
SELECT c.doc_id, c.leaf, h.digest AS subroot, r.digest AS root, sha256(c.met) AS proof_sha256, c.folded AS folded_root,
  c.folded = r.digest AS verified
FROM climb c JOIN high h ON h.level = 0 AND h.pos = c.home JOIN high r ON r.n = 1
WHERE c.tree = -1 AND c.n = 1
"""
