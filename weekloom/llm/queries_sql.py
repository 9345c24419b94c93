"""DuckDB SQL for the rows of the dealt operators that SQL can express."""

from __future__ import annotations

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Runs of words by text, CRC-32 a byte at a time over the distinct runs, counts, gains, and the draw.
OP11 = rf"""
WITH RECURSIVE
bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM bits WHERE k < 8
),
step AS (SELECT i, v FROM bits WHERE k = 8),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
),
words AS (
  SELECT side, r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
),
runs AS (
  SELECT side, r, unnest(w) AS f FROM words
  UNION ALL
  SELECT side, r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL
  SELECT side, r, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
),
features AS (SELECT side, r, f, count(*) AS n FROM runs GROUP BY ALL),
names AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM features),
crc(f, h, k, v) AS (
  SELECT f, h, 0, 4294967295 FROM names
  UNION ALL
  SELECT f, h, k + 1, xor(s.v, c.v >> 8)
  FROM crc c JOIN step s ON s.i = xor(c.v, ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) & 255
  WHERE 2 * k < length(h)
),
buckets AS (SELECT f, xor(v, 4294967295) % 10000 AS bucket FROM crc WHERE 2 * k = length(h)),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM features JOIN buckets USING (f) GROUP BY bucket
),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts
),
weights AS (
  SELECT r, sum(n) AS n_features, sum(n * gain) AS weight
  FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
),
scored AS (
  SELECT w.doc_id, len(w.w) >= 20 AS enough, coalesce(x.n_features, 0)::BIGINT AS n_features,
    coalesce(x.weight, 0)::BIGINT AS weight,
    (coalesce(x.weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('42:' || coalesce(w.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM words w LEFT JOIN weights x USING (r) WHERE w.side = 'd'
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id NULLS FIRST) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN enough AND place <= (SELECT count(*) * 5 // 100 FROM scored WHERE enough) THEN place END AS rank
FROM ranked
"""

#: Every window by its words; all but the first of a sequence cover what goes.
OP8 = r"""
WITH
texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
windows AS (
  SELECT r, doc_id, unnest(list_transform(range(1, greatest(len(w) - 18, 1)),
    lambda i: {'place': i, 'key': array_to_string(w[i:i + 19], ' ')})) AS x
  FROM texts
),
later AS (
  SELECT r, x.place AS place FROM windows
  QUALIFY row_number() OVER (PARTITION BY x.key ORDER BY doc_id NULLS LAST, r, x.place) > 1
),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM texts),
covered AS (
  SELECT r, place, word,
    max(l.place) OVER (PARTITION BY r ORDER BY place ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words LEFT JOIN later l USING (r, place)
),
kept AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS rest
  FROM covered GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""

#: Equal sets are one node; sets that share a shingle are compared; the closure of the links gives components.
OP10 = rf"""
WITH RECURSIVE
texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) BETWEEN 1 AND 2 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: array_to_string(w[i:i + 2], ' ')))) END AS s
  FROM texts
),
nodes AS (SELECT s, row_number() OVER () AS node FROM (SELECT DISTINCT s FROM sets WHERE len(s) > 0)),
members AS (SELECT node, unnest(s) AS shingle FROM nodes),
links AS (
  SELECT a.node AS x, b.node AS y
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.node <> b.node
  JOIN nodes p ON p.node = a.node JOIN nodes q ON q.node = b.node
  GROUP BY a.node, b.node
  HAVING 100 * count(*) >= 85 * (any_value(len(p.s)) + any_value(len(q.s)) - count(*))
),
reached(x, y) AS (
  SELECT node, node FROM nodes
  UNION
  SELECT c.x, l.y FROM reached c JOIN links l ON l.x = c.y
),
roots AS (
  SELECT c.x AS node, min(t.doc_id) AS root
  FROM reached c JOIN nodes n ON n.node = c.y JOIN sets t ON t.s = n.s GROUP BY c.x
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN node IS NULL THEN doc_id ELSE root END AS component_id,
  coalesce(doc_id = CASE WHEN node IS NULL THEN doc_id ELSE root END, false) AS kept
FROM sets LEFT JOIN nodes USING (s) LEFT JOIN roots USING (node)
"""

#: Nodes by the text of their whole sequence; what adds up along the trie is joined to all prefixes of a
#: node's first member. Turns of one conversation with equal ``turn`` have no order in SQL; the tables have none.
OP13 = r"""
WITH RECURSIVE
bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM bits WHERE k < 8
),
step AS (SELECT i, v FROM bits WHERE k = 8),
own AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
crc(c, h, k, v) AS (
  SELECT c, hex(encode(c::VARCHAR)), 0, 4294967295 FROM own
  UNION ALL
  SELECT c, h, k + 1, xor(s.v, p.v >> 8)
  FROM crc p JOIN step s ON s.i = xor(p.v, ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) & 255
  WHERE 2 * k < length(h)
),
heads AS (SELECT c, xor(v, 4294967295) % 9 AS h FROM crc WHERE 2 * k = length(h)),
rebuilt AS (
  SELECT o.c, list_concat(coalesce(f.t, [])[1:h], o.t[h + 1:]) AS t
  FROM own o JOIN heads USING (c) LEFT JOIN own f ON f.c = o.c - ((o.c % 5) + 5) % 5
),
places AS (SELECT c, t, unnest(range(0, len(t) + 1)) AS depth FROM rebuilt),
prefixes AS (
  SELECT c, depth, to_json(t[1:depth])::VARCHAR AS key, to_json(t[1:depth - 1])::VARCHAR AS above, len(t) = depth AS ends,
    CASE WHEN depth > 0 THEN octet_length(encode(t[depth].text)) ELSE 0 END AS bytes
  FROM places
),
nodes AS (
  SELECT depth, key, min(c) AS c, any_value(CASE WHEN depth > 0 THEN above END) AS above, count(*) AS n_convs,
    any_value(bytes) AS bytes, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, key
),
families AS (SELECT depth - 1 AS depth, above AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
sized AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN families USING (depth, key)),
sums AS (
  SELECT p.depth, p.key, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved_tokens
  FROM sized n JOIN prefixes p ON p.c = n.c AND p.depth <= n.depth GROUP BY p.depth, p.key
)
SELECT n.c::BIGINT AS conv_id, n.depth::BIGINT AS depth, u.c::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  n.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM sized n JOIN sums USING (depth, key) LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.key = n.above
"""

SQL: dict[str, str] = {
    "op8_substring_dedup": OP8,
    "op10_minhash_near_dedup": OP10,
    "op11_importance_resampling": OP11,
    "op13_prefix_trie": OP13,
}
