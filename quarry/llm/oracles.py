"""DuckDB SQL for the queries that SQL can express."""

OP8 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0') AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS s
  FROM d GROUP BY source),
f AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
g AS (
  SELECT *, most * sum(w) OVER (ORDER BY most / w, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         <= (total - coalesce(sum(most) OVER (ORDER BY most / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS capped
  FROM f),
t AS (
  SELECT source, s, source_size,
         CASE WHEN capped THEN most
              ELSE (total - coalesce(sum(CASE WHEN capped THEN most END) OVER (), 0)) * w / sum(CASE WHEN NOT capped THEN w END) OVER () END AS target
  FROM g),
o AS (
  SELECT d.doc_id, d.size, t.s, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
-- the schedule: bit-reversed slots fall into the sources' intervals of blocks
c AS (
  SELECT s, CAST(ceil(floor(target) / 1024) AS BIGINT) AS blocks, CAST(sum(ceil(floor(target) / 1024)) OVER (ORDER BY s) AS BIGINT) AS upto,
         CAST(sum(ceil(floor(target) / 1024)) OVER () AS BIGINT) AS n
  FROM (SELECT s, any_value(target) AS target FROM t GROUP BY s) AS x),
i AS (
  SELECT *, length(bin(n)) + 1 AS bits, ((upto - blocks)::HUGEINT << (length(bin(n)) + 1)) // n AS low, (upto::HUGEINT << (length(bin(n)) + 1)) // n AS high
  FROM c WHERE blocks > 0),
j AS (
  SELECT r.slot, CAST('0b' || reverse(lpad(bin(r.slot), CAST(bits AS INTEGER), '0')) AS BIGINT) AS point
  FROM (SELECT any_value(n) AS n, any_value(bits) AS bits FROM i) AS y, range(0, n) AS r(slot)),
e AS (
  SELECT i.s, j.slot, row_number() OVER (PARTITION BY i.s ORDER BY j.slot) - 1 AS rank FROM i JOIN j ON j.point >= i.low AND j.point < i.high)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - off)) + greatest(0, least(size, floor(target) - source_size - off)) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND off < floor(target) THEN coalesce(e.slot, i.n + i.upto - i.blocks + off // 1024) END AS slot
FROM o LEFT JOIN i ON i.s = o.s LEFT JOIN e ON e.s = o.s AND e.rank = off // 1024
"""

OP11 = r"""
WITH e AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS BIGINT) AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v, row_number() OVER () AS n
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT a.n AS anchor, a.vec_id AS anchor_id, c.n, c.vec_id, a.label = c.label AS same,
         CAST(list_sum([a.v[i] * c.v[i] FOR i IN range(1, least(len(a.v), len(c.v)) + 1)]) AS BIGINT) AS score
  FROM e a JOIN e c ON a.n <> c.n
  WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, n AS positive
  FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, n) <= 5)
SELECT pos.anchor_id, pos.positive_id, p.vec_id AS negative_id, pos.positive_score, p.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY pos.anchor, pos.positive ORDER BY p.score DESC, p.vec_id NULLS LAST, p.n) AS INTEGER) AS rank
FROM pos JOIN p ON p.anchor = pos.anchor AND NOT p.same
 AND 80 * pos.positive_score <= 100 * p.score AND p.score <= pos.positive_score
QUALIFY rank <= 5
"""

OP12 = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, s, i, x) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM t
  UNION ALL
  SELECT conv_id, s, i + 1, CASE WHEN y % 2 = 1 THEN xor(y >> 1, CAST(3988292384 AS BIGINT)) ELSE y >> 1 END
  FROM (SELECT conv_id, s, i, CASE WHEN i % 8 = 0 THEN xor(x, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE x END AS y FROM crc WHERE i < 8 * length(s)) AS b),
h AS (
  SELECT conv_id, conv_id - conv_id % 100 AS first, xor(x, CAST(4294967295 AS BIGINT)) % 6 AS h FROM crc WHERE i = 8 * length(s)),
r AS (
  SELECT h.conv_id, 0 AS part, pos, role, text FROM h JOIN t ON t.conv_id = h.first AND pos <= h.h
  UNION ALL
  SELECT h.conv_id, 1, pos, role, text FROM h JOIN t ON t.conv_id = h.conv_id AND pos > h.h),
o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, role, text FROM r),
path AS (
  SELECT conv_id, depth, length(text) AS n_chars, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS k FROM o
  UNION ALL
  SELECT conv_id, 0, 0, CAST([] AS STRUCT(r VARCHAR, t VARCHAR)[]) FROM h),
node AS (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_chars) AS n_chars FROM path GROUP BY k, depth),
child AS (
  SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT p.k, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.n_chars) AS saved_tokens
  FROM node u LEFT JOIN child c ON c.k = u.k JOIN path p ON p.conv_id = u.conv_id AND p.depth <= u.depth
  GROUP BY p.k),
ends AS (
  SELECT k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT * FROM path QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) AS w GROUP BY k)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(c.n_children, 0) AS n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node n JOIN below b ON b.k = n.k
LEFT JOIN child c ON c.k = n.k
LEFT JOIN ends e ON e.k = n.k
LEFT JOIN node up ON n.depth > 0 AND up.k = n.k[1:n.depth - 1]
"""
