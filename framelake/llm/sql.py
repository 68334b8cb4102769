"""DuckDB SQL of the queries that SQL can express.

None for op1 (a tokenizer), op2 (XXH64 draws), op3 and op9 (fitted models), op7 (XXH64), op8 (alignment) and
op11 (eigenvectors); tests hold
these against brute force, exact round trips or held-out accuracy.
"""

from __future__ import annotations

OP4 = "SELECT doc_id, source, n_chars, md5(text) AS text_md5 FROM documents"

OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), lows AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN lows ON lows.a = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id
"""

OP6 = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(h, p, v) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT parts.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN best ON best.page_id = parts.page_id
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
cuts AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, cuts.n AS n, item_id FROM cuts JOIN wins USING (n, win)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

OP12 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS keep FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM d
"""

OP13 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) <= 3
"""

ORACLES: dict[str, str] = {"op4_sharding": OP4, "op5_embedding": OP5, "op6_urls": OP6, "op10_decontamination": OP10, "op12_warc": OP12, "op13_negatives": OP13}
