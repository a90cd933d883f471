"""DuckDB SQL of the operators that have a practical form in it, over whole tables.

All inner products (op3), all cosines and a recursive walk over the links (op6),
shingle sets with list functions, joined by shingle, and the same walk (op7).
"""

from __future__ import annotations

TOP_K = """WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
  FROM kept q JOIN kept r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id AND len(q.v) = len(r.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

SPHERICAL_CAPS = """WITH RECURSIVE kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), unit AS (
  SELECT vec_id, v FROM kept WHERE len(list_filter(v, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), walk AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION SELECT walk.node, links.b FROM walk JOIN links ON links.a = walk.seen
), least AS (SELECT node, min(seen) AS component_id FROM walk GROUP BY node
), degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON node = e.vec_id LEFT JOIN degrees ON degrees.a = e.vec_id
"""

SUPERMINHASH = r"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM worded
), classes AS (
  SELECT list_sort(s) AS s, min(doc_id) AS first FROM sets WHERE len(s) > 0 GROUP BY 1
), members AS (
  SELECT doc_id, len(sets.s) AS n, first FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s
), items AS (
  SELECT first, len(s) AS n, unnest(s) AS item FROM classes
), links AS MATERIALIZED (
  SELECT a.first AS a, b.first AS b FROM items a JOIN items b ON a.item = b.item AND a.first <> b.first
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.first, b.first, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), walk AS (
  SELECT first AS node, first AS seen FROM classes
  UNION SELECT walk.node, links.b FROM walk JOIN links ON links.a = walk.seen
), reached AS (SELECT node, min(seen) AS component_id FROM walk GROUP BY node)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  coalesce(component_id, doc_id) = doc_id AS kept
FROM members LEFT JOIN reached ON node = first
"""
