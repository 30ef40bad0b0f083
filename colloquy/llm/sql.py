"""Oracle SQL (DuckDB) of the two near-duplicate queries."""

OP2_SQL = r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
                      WHEN len(words) = 1 THEN [words[1]]
                      ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS s
  FROM w),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
  WHERE 100 * least(na.n, nb.n) >= 80 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM sizes
  UNION
  SELECT r.node, l.b FROM reach r JOIN edges l ON r.seen = l.a)
SELECT z.doc_id, z.n AS n_shingles, min(r.seen) AS component_id, min(r.seen) = z.doc_id AS kept
FROM sizes z JOIN reach r ON r.node = z.doc_id GROUP BY z.doc_id, z.n
"""

OP10_SQL = """
WITH RECURSIVE
v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a)
SELECT e.vec_id, coalesce(any_value(d.n), 0)::BIGINT AS n_links, min(r.seen) AS component_id, min(r.seen) = e.vec_id AS kept
FROM embeddings e JOIN reach r ON r.node = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id GROUP BY e.vec_id
"""
