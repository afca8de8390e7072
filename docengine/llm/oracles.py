"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

import string

#: Only A-Z is lowered, as the contracts say.
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

_COMPONENTS = """reach AS (
    SELECT id, id AS component FROM vertices
    UNION
    SELECT l.b, r.component FROM reach r JOIN links l ON l.a = r.id WHERE r.component < l.b),
  classes AS (SELECT id, min(component) AS component_id FROM reach GROUP BY id)"""

#: Every row is a vector of its own: rows that repeat link with each other, and rows of one id have the component of their vector.
NEAR_VECTORS = """WITH RECURSIVE r AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id AS id, embedding FROM embeddings),
  v AS MATERIALIZED (SELECT r, id, embedding::DOUBLE[] AS e FROM r
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS MATERIALIZED (SELECT x.r AS a, y.r AS b, y.id AS b_id FROM v x JOIN v y ON x.r <> y.r AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.9),
  reach AS (
    SELECT r, id AS component FROM r
    UNION
    SELECT l.b, reach.component FROM reach JOIN links l ON l.a = reach.r WHERE reach.component < l.b_id),
  classes AS (SELECT r, min(component) AS component_id FROM reach GROUP BY r)
  SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
  FROM r JOIN classes USING (r) LEFT JOIN (SELECT a AS r, count(*) AS n FROM links GROUP BY a) USING (r)"""

JACCARD = rf"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id AS id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS l FROM documents),
  s AS MATERIALIZED (SELECT DISTINCT id, unnest(list_transform(range(greatest(len(l) - 4, 1)), lambda i: array_to_string(l[i + 1:i + 5], ' '))) AS g FROM w WHERE len(l) > 0),
  n AS MATERIALIZED (SELECT id, count(*) AS n FROM s GROUP BY id),
  vertices AS (SELECT id FROM w),
  links AS MATERIALIZED (SELECT a, b FROM (SELECT x.id AS a, y.id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY ALL)
    JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * i >= 80 * (p.n + q.n - i)),
  {_COMPONENTS}
  SELECT w.id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM w JOIN classes USING (id) LEFT JOIN n USING (id)"""

DECONTAMINATION = rf"""WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM documents),
  b AS MATERIALIZED (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM benchmark),
  bw AS MATERIALIZED (SELECT DISTINCT item_id, least(len(l), 13) AS k, unnest(list_transform(range(len(l) - least(len(l), 13) + 1), lambda i: array_to_string(l[i + 1:i + least(len(l), 13)], ' '))) AS g FROM b WHERE len(l) > 0),
  dw AS MATERIALIZED (SELECT doc_id, k, unnest(range(len(l) - k + 1)) AS pos, unnest(list_transform(range(len(l) - k + 1), lambda i: array_to_string(l[i + 1:i + k], ' '))) AS g FROM d, (SELECT DISTINCT k FROM bw) WHERE len(l) >= k),
  m AS MATERIALIZED (SELECT doc_id, item_id, pos, dw.k FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
  h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM m) GROUP BY doc_id),
  i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
  SELECT doc_id, len(l)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(l) AS contaminated
  FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)"""

NEGATIVES = """WITH v AS MATERIALIZED (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  n AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM v),
  s AS MATERIALIZED (SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, coalesce(list_inner_product(a.e, b.e), 0)::BIGINT AS score
    FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
  p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) AS k FROM s WHERE same QUALIFY k <= 5),
  c AS (SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
      row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.other_id) AS rank
    FROM p JOIN s ON s.r = p.r AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
  SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM c WHERE rank <= 3"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS l FROM documents),
  a AS MATERIALIZED (SELECT count(*)::BIGINT AS n, sum(len(l))::BIGINT AS total FROM d WHERE len(l) > 0),
  t AS MATERIALIZED (SELECT r, g, count(*)::BIGINT AS tf FROM (SELECT r, unnest(l) AS g FROM d) GROUP BY ALL),
  w AS MATERIALIZED (SELECT g, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, a GROUP BY g, n),
  i AS MATERIALIZED (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS l FROM (SELECT DISTINCT item_id, text FROM benchmark)),
  q AS MATERIALIZED (SELECT i, g, count(*)::BIGINT AS times FROM (SELECT i, unnest(l) AS g FROM i) GROUP BY ALL),
  m AS MATERIALIZED (SELECT r, 100 - 75 + (75 * len(l) * n) // total AS m FROM d, a),
  s AS MATERIALIZED (SELECT i, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN t USING (g) JOIN w USING (g) JOIN m USING (r) GROUP BY ALL),
  k AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s JOIN d USING (r) WHERE score > 0 QUALIFY rank <= 10)
  SELECT item_id, rank::INT AS rank, doc_id, score FROM k JOIN i USING (i)"""
