"""SQL for DuckDB that gives what the queries give, where SQL can say it."""

OP7 = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM whole q JOIN whole c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP9 = """
WITH RECURSIVE worded AS (
    SELECT doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id,
           CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
           END AS s
    FROM worded
), spread AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), linked AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM spread a JOIN spread b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reach r JOIN linked l ON l.a = r.b
), least AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON doc_id = a
"""

OP12 = """
WITH whole AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.id AS anchor_id, c.id, a.label = c.label AS same,
           list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM whole a JOIN whole c ON c.id <> a.id
    WHERE a.id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
QUALIFY rank <= 5
"""

ORACLES = {"op9_odd_sketches": OP9, "op7_vector_approximation": OP7, "op12_shared_lists": OP12}
