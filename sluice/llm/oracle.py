"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {_BLANK}), {_UPPER}) AS line_key FROM lines
), shared AS (
  SELECT line_key, min(doc_id) AS first_id FROM keyed
  WHERE length(line_key) >= 10 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, s.first_id IS NOT NULL AND s.first_id <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN shared s ON k.line_key = s.line_key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP3_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, r.seen FROM reach r JOIN both_ways e ON e.a = r.node
), component AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component c ON c.node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

OP10_SQL = """
WITH RECURSIVE rows AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), sound AS (
  SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM rows
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND x.norm > 0 AND y.norm > 0
  AND list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.93
), reach(node, seen) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT l.b, r.seen FROM reach r JOIN links l ON l.a = r.node
), component AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
), degree AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN component c ON c.node = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""

OP8_SQL = """
WITH hashed AS (
  SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h,
         octet_length(encode(coalesce(text, ''))) AS n_bytes
  FROM documents
), ladder AS (
  SELECT doc_id, n_bytes, CAST(d AS INT) AS depth, h >> CAST(60 - d AS BIGINT) AS prefix
  FROM hashed, range(0, 61) r(d)
), buckets AS (
  SELECT depth, prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS n FROM ladder GROUP BY ALL
), fitting AS (
  SELECT l.doc_id, l.depth, l.prefix, l.n_bytes, b.shard_bytes,
         row_number() OVER (PARTITION BY l.doc_id ORDER BY l.depth) AS r
  FROM ladder l JOIN buckets b ON b.depth = l.depth AND b.prefix = l.prefix
  WHERE b.shard_bytes <= 1048576 OR b.n = 1
)
SELECT doc_id, depth, prefix, CAST(0 AS BIGINT) AS overflow, n_bytes, shard_bytes FROM fitting WHERE r = 1
"""

OP13_SQL = """
WITH own AS (
  SELECT conv_id, list({r: coalesce(role, ''), x: coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT conv_id, t, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), CAST(range(8) AS BIGINT[])),
      lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % 6 AS h
  FROM own
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.t[1:o.h], []), o.t[o.h + 1:]) AS t
  FROM hashed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), steps AS (
  SELECT conv_id, t, len(t) AS turns, unnest(range(0, len(t) + 1)) AS depth FROM rebuilt
), prefixes AS (
  SELECT conv_id, turns, depth, coalesce(length(t[depth].x), 0) AS chars,
         md5(array_to_string(list_transform(t[1:depth], lambda e: md5(e.r) || md5(e.x)), '')) AS node
  FROM steps
), nodes AS (
  SELECT p.node, min(p.conv_id) AS conv_id, min(p.depth) AS depth, count(*) AS n_convs, min(p.chars) AS chars,
         min(q.node) AS parent,
         sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (p.depth = p.turns), '')) AS ends_sha256
  FROM prefixes p LEFT JOIN prefixes q ON q.conv_id = p.conv_id AND q.depth = p.depth - 1 GROUP BY p.node
), children AS (
  SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT DISTINCT p.node AS top, q.node FROM prefixes p JOIN prefixes q ON p.conv_id = q.conv_id AND p.depth <= q.depth
), sums AS (
  SELECT top, CAST(count(*) FILTER (c.parent IS NULL) AS BIGINT) AS n_leaves,
         CAST(sum((n.n_convs - 1) * n.chars) AS BIGINT) AS saved_tokens
  FROM below b JOIN nodes n ON n.node = b.node LEFT JOIN children c ON c.parent = n.node GROUP BY top
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
       n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.top = n.node LEFT JOIN nodes u ON u.node = n.parent LEFT JOIN children c ON c.parent = n.node
"""

OP12_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

LLM_ORACLE = {
    "op1_line_dedup": OP1_SQL,
    "op3_minhash_dedup": OP3_SQL,
    "op8_sharding": OP8_SQL,
    "op10_embedding_dedup": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_conversation_trie": OP13_SQL,
}
