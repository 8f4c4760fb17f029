"""DuckDB SQL of the queries that SQL can express, over the driver's views."""

from __future__ import annotations

from riskframe.llm.catalog import LISTED_WORDS, URL_RULES
from riskframe.llm.license import PHRASES, TEMPLATES, needed, span
from riskframe.llm.urls import MAX_DOMAIN

ORACLE: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLE["op1_mix"] = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS source, source IS NULL AS no_source,
    coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS size
  FROM documents),
totals AS (
  SELECT no_source, source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY no_source, source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY no_source, source) - 1) % 3]::DOUBLE AS weight,
    source_size * 2.0 AS cap
  FROM totals),
shared AS (
  SELECT *, ((SELECT sum(source_size) FROM totals) * 1.5
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, no_source, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, no_source, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed),
targets AS (
  SELECT no_source, source, weight, source_size, least((SELECT max(share) FROM shared) * weight, cap) AS target FROM shared),
queued AS (
  SELECT d.*, t.weight, t.source_size, t.target, floor(t.target + 1e-6) AS served,
    sum(size) OVER (PARTITION BY d.no_source, d.source
      ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || CAST(size AS VARCHAR)), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs d JOIN targets t ON d.no_source = t.no_source AND d.source = t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target,
  CAST(greatest(0, least(size, served - (upto - size))) + greatest(0, least(size, served - (upto - size + source_size))) AS BIGINT) AS taken,
  CAST(upto / weight AS DOUBLE) AS finish
FROM queued
"""

ORACLE["op5_exact"] = f"""
WITH docs AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
grouped AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM docs GROUP BY t)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM docs d JOIN grouped g ON d.t = g.t
"""

ORACLE["op4_substring"] = rf"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS words FROM documents),
windows AS (
  SELECT doc_id, start, md5(array_to_string(list_slice(words, start, start + 49), ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS start FROM docs WHERE len(words) >= 50)),
firsts AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 50)) AS place
  FROM windows JOIN firsts USING (h) WHERE doc_id > first_doc),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS text, count(*) AS n
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place WHERE g.place IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(len(d.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _phrase(phrase: str) -> str:
    return " AND ".join(f"w{i} = '{w}'" for i, w in enumerate(phrase.split()))


_TEMPLATES = ", ".join(f"({t}, '{label}', '{w}', {len(set(text.split()))}, {needed(len(set(text.split())))}, {span(len(text.split())) // 2})"
                       for t, (label, text) in enumerate(TEMPLATES) for w in sorted(set(text.split())))
_CASES = " ".join(f"WHEN {_phrase(p)} THEN '{label}'" for p, label in PHRASES.items())
ORACLE["op7_license"] = rf"""
WITH docs AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
listed AS (SELECT doc_id, regexp_extract_all(t, '{_ALNUM}') AS words FROM docs),
placed AS (SELECT doc_id, unnest(words) AS w0, unnest(range(0, len(words))) AS i FROM listed),
sequences AS (
  SELECT *, lead(w0, 1) OVER place AS w1, lead(w0, 2) OVER place AS w2, lead(w0, 3) OVER place AS w3
  FROM placed WINDOW place AS (PARTITION BY doc_id ORDER BY i)),
base AS (SELECT doc_id, i, CASE {_CASES} END AS label FROM sequences),
based AS (
  SELECT doc_id, count(*) AS n, min(i) AS first_word, max(i) AS last_word FROM base WHERE label IS NOT NULL GROUP BY doc_id),
templates(t, label, word, n, need, half) AS (VALUES {_TEMPLATES}),
lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(0, len(string_split(t, chr(10))))) AS k FROM docs),
line_lists AS (SELECT doc_id, k, regexp_extract_all(line, '{_ALNUM}') AS words FROM lines),
line_words AS (SELECT doc_id, k, unnest(words) AS word, unnest(range(0, len(words))) AS i FROM line_lists),
units AS (SELECT doc_id, k, i, word FROM line_words UNION ALL SELECT doc_id, -1 AS k, i, w0 AS word FROM placed),
hits AS (SELECT u.doc_id, u.k, u.i // t.half AS part, t.* FROM units u JOIN templates t ON u.word = t.word),
blocks AS (SELECT * FROM hits UNION ALL SELECT * REPLACE (part - 1 AS part) FROM hits WHERE part > 0),
shared_words AS (
  SELECT doc_id, k, part, t, label, count(DISTINCT word) AS shared, max(n) AS n, max(need) AS need
  FROM blocks GROUP BY doc_id, k, part, t, label),
scores AS (SELECT doc_id, max(shared / n) AS score FROM shared_words WHERE shared >= need GROUP BY doc_id),
found AS (SELECT DISTINCT doc_id, label FROM shared_words WHERE shared >= need),
own AS (SELECT DISTINCT doc_id, label FROM base WHERE label IS NOT NULL),
own_text AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM own GROUP BY doc_id),
all_text AS (
  SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT * FROM own UNION SELECT * FROM found) GROUP BY doc_id)
SELECT l.doc_id, CAST(len(l.words) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, b.first_word, b.last_word,
  coalesce(o.labels, '') AS base_labels, coalesce(a.labels, '') AS labels, CAST(coalesce(s.score, 0.0) AS DOUBLE) AS score
FROM listed l LEFT JOIN based b ON l.doc_id = b.doc_id LEFT JOIN own_text o ON l.doc_id = o.doc_id
  LEFT JOIN all_text a ON l.doc_id = a.doc_id LEFT JOIN scores s ON l.doc_id = s.doc_id
"""

ORACLE["op11_negatives"] = """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS own, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scored WHERE own)
  WHERE place <= 5),
negatives AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS place
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id
  WHERE NOT n.own AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 5
"""

_RULES = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.host + r.path}'"
    for r in sorted(URL_RULES, key=lambda r: -len(r.host + r.path)))
_VERDICTS = " ".join(f"WHEN '{r.host + r.path}' THEN '{r.verdict}'" for r in URL_RULES)
_WORDS = ", ".join(f"'{w}'" for w in LISTED_WORDS)
ORACLE["op12_urls"] = rf"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
ruled AS (SELECT *, CASE {_RULES} END AS rule, string_split(host, '.') AS labels FROM parts),
listed AS (
  SELECT *, len(list_filter(range(1, len(labels) + 1), lambda i:
    len(array_to_string(labels[i:], '.')) <= {MAX_DOMAIN} AND list_has_any(string_split(labels[i], '-'), [{_WORDS}]))) > 0 AS hit
  FROM ruled)
SELECT page_id, host, path, rule, CASE rule {_VERDICTS} ELSE CASE WHEN hit THEN 'block' ELSE 'allow' END END AS verdict
FROM listed
"""


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# CRC-32 one bit at a time: the eight steps of a byte inside those over the bytes
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda v, z: xor(v >> 1, (v & 1) * 3988292384::BIGINT)))"""
ORACLE["op13_merkle"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("replace(text, chr(10), '')")} AS other,
    coalesce((xor({_CRC}, 4294967295::BIGINT)) % 2 = 0, false) AS tampered
  FROM documents),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM docs),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, n AS size FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (size + 2) // 3
  FROM low WHERE size > 1 GROUP BY tree, level, size, pos // 3),
subroots AS (SELECT tree, level AS height, digest FROM low WHERE size = 1),
high AS (
  SELECT -1 AS tree, 0 AS level, tree AS pos, digest, (SELECT count(*) FROM subroots) AS size FROM subroots
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (size + 2) // 3
  FROM high WHERE size > 1 GROUP BY tree, level, size, pos // 3),
nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
beside AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.size > 1 GROUP BY a.tree, a.level, a.pos),
numbered AS (SELECT *, row_number() OVER () AS id FROM placed),
path AS (
  SELECT d.id, b.level AS step, b.l, b.r
  FROM numbered d JOIN beside b ON d.tree = b.tree AND d.pos // CAST(pow(3, b.level) AS BIGINT) = b.pos
  UNION ALL
  SELECT d.id, s.height + b.level, b.l, b.r
  FROM numbered d JOIN subroots s ON d.tree = s.tree
    JOIN beside b ON b.tree = -1 AND d.tree // CAST(pow(3, b.level) AS BIGINT) = b.pos),
proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256 FROM path GROUP BY id),
folded AS (
  SELECT id, 0 AS step, CASE WHEN tampered THEN other ELSE leaf END AS h FROM numbered
  UNION ALL
  SELECT f.id, f.step + 1, sha256(p.l || f.h || p.r) FROM folded f JOIN path p ON f.id = p.id AND f.step = p.step),
final AS (SELECT id, max_by(h, step) AS folded_root FROM folded GROUP BY id)
SELECT d.doc_id, d.leaf, s.digest AS subroot, t.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
  f.folded_root, f.folded_root = t.digest AS verified
FROM numbered d JOIN subroots s ON d.tree = s.tree JOIN final f ON d.id = f.id LEFT JOIN proofs p ON d.id = p.id
  CROSS JOIN (SELECT digest FROM high WHERE size = 1) t
"""
