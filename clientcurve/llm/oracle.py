"""DuckDB SQL of the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op8_mix_sources"] = r"""
WITH base AS (
  SELECT doc_id, source,
         CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 12) AS key
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
ranked AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) AS cap,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM totals),
filled AS (
  SELECT *, cap / weight AS ratio,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_from
  FROM ranked),
lev AS (SELECT max((budget - cap_before) / weight_from) AS level FROM filled WHERE (budget - cap_before) / weight_from <= ratio),
targets AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target
  FROM filled, lev),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM targets),
run AS (
  SELECT b.doc_id, b.size, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS rest,
         CAST(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto,
         CAST(sum(b.size) OVER (PARTITION BY b.source, b.key) AS BIGINT) AS here
  FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       size * (copies + CASE WHEN rest > 0 AND (upto <= rest OR (upto - here <= rest AND upto - rest < rest - (upto - here))) THEN 1 ELSE 0 END) AS taken
FROM run
"""

ORACLES["op4_preference"] = r"""
WITH t AS (
  SELECT conv_id AS pair, turn, role, text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) = 1),
e AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY pair ORDER BY turn DESC) = 1),
r AS (
  SELECT t.pair, t.turn, t.role, t.text FROM t JOIN e ON t.pair = e.pair WHERE t.turn < e.turn
  UNION ALL
  SELECT e.pair, e.turn, o.role, o.text FROM e JOIN e AS o ON o.pair = xor(e.pair, 1)),
j AS (
  SELECT coalesce(c.pair, r.pair) AS pair, coalesce(c.turn, r.turn) AS turn,
         c.pair IS NOT NULL AS in_c, r.pair IS NOT NULL AS in_r,
         c.role AS c_role, c.text AS c_text, r.role AS r_role, r.text AS r_text,
         c.pair IS NOT NULL AND r.pair IS NOT NULL AND c.role IS NOT DISTINCT FROM r.role
           AND c.text IS NOT DISTINCT FROM r.text AS same
  FROM t AS c FULL JOIN r ON c.pair = r.pair AND c.turn = r.turn),
s AS (SELECT pair, min(turn) AS split FROM j WHERE NOT same GROUP BY pair),
k AS (SELECT j.*, s.split IS NULL OR j.turn < s.split AS in_prompt FROM j LEFT JOIN s ON j.pair = s.pair),
parts AS (
  SELECT pair, turn, 'prompt' AS part, c_role AS role, c_text AS text FROM k WHERE in_prompt
  UNION ALL SELECT pair, turn, 'chosen', c_role, c_text FROM k WHERE NOT in_prompt AND in_c
  UNION ALL SELECT pair, turn, 'rejected', r_role, r_text FROM k WHERE NOT in_prompt AND in_r),
o AS (
  SELECT *, '<|im_start|>' || coalesce(role, '') || chr(10) AS header,
         '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered,
         part <> 'prompt' AND coalesce(role = 'assistant', false) AS carries
  FROM parts)
SELECT pair AS pair_id, part, turn, role, rendered,
       CAST(CASE WHEN carries THEN length(header) ELSE 0 END AS INTEGER) AS mask_from,
       CAST(CASE WHEN carries THEN length(rendered) ELSE 0 END AS INTEGER) AS mask_to
FROM o
"""

ORACLES["op1_exact_topk"] = r"""
WITH v AS (
  SELECT vec_id AS id, min(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.id AS query_id, c.id AS vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.id <> c.id AND len(q.vec) = len(c.vec)
  WHERE q.id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

ORACLES["op11_warc_bundles"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (
  SELECT *, payload_bytes >= 1000 AS long, row_number() OVER (PARTITION BY payload_digest, payload_bytes ORDER BY page_id DESC NULLS LAST) AS place,
         max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN long AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN long AND place > 1 THEN first END AS refers_to
FROM r
"""

ORACLES["op12_lexical_bags"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS docs, sum(len(terms)) AS total FROM d WHERE len(terms) > 0),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
o AS (SELECT row, unnest(terms) AS term FROM d),
t AS (SELECT row, term, count(*) AS tf FROM o WHERE term IN (SELECT term FROM i) GROUP BY row, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(s.docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term),
m AS (SELECT row, doc_id, 100 - 50 + CAST((50 * len(terms) * s.docs) // s.total AS BIGINT) AS m FROM d, s WHERE len(terms) > 0),
p AS (SELECT t.row, t.term, m.doc_id, w.w * CAST((1000000000 * t.tf) // (1000 * t.tf + 20 * m.m) AS BIGINT) AS part FROM t JOIN m ON t.row = m.row JOIN w ON t.term = w.term),
f AS (SELECT i.item_id, p.row, any_value(p.doc_id) AS doc_id, CAST(sum(p.part) AS BIGINT) AS score FROM i JOIN p ON i.term = p.term GROUP BY i.item_id, p.row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM f WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= 50
"""

ORACLES["op13_hard_negatives"] = r"""
WITH u AS (
  SELECT vec_id AS id, min({'vec': list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))),
                            'label': CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END}) AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
v AS (SELECT id, r.vec AS vec, r.label AS label FROM u),
s AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, CAST(list_inner_product(a.vec, c.vec) AS BIGINT) AS score
  FROM v AS a JOIN v AS c ON a.id <> c.id AND len(a.vec) = len(c.vec)
  WHERE a.id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
