"""DuckDB SQL for the registered queries that SQL can express."""

_FINE = """vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
_WHOLE = "list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT)"

OP5 = f"""
WITH vectors AS (SELECT vec_id, {_WHOLE}::DOUBLE[] AS v FROM embeddings WHERE {_FINE}),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""

OP11 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
           coalesce(source, '') AS source FROM documents),
words AS (
    SELECT r, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(total) AS all_n FROM kept GROUP BY ALL),
pairs AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
cells AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total, l.v, l.all_n,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS own_n
    FROM pairs g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
    LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
shares AS (
    SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (own_n + 2 * v) AS p,
           1 + (1000000000::HUGEINT * (total + 2)) // (all_n + 2 * v) AS q FROM cells),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
    SELECT lang, source, part, item, value::BIGINT AS value,
           row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10"""

OP12 = """
WITH RECURSIVE able AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m.b, vec_id)) AS kept
FROM embeddings LEFT JOIN counts c ON c.a = vec_id LEFT JOIN least m ON m.a = vec_id"""


def _op13(k=16, rounds=3):
    near = """
near{i} AS (
    SELECT vec_id, v, d, c FROM (
        SELECT r.vec_id, r.v, m.c, list_sum(list_transform(list_zip(r.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM kept r CROSS JOIN centres{i} m)
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"""
    moved = """
cells{i} AS (SELECT c, unnest(v) AS x, unnest(range(64)) AS place FROM near{i}),
sums{i} AS (SELECT c, place, sum(x)::BIGINT AS s, count(*) AS n FROM cells{i} GROUP BY ALL),
means{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY place) AS v FROM sums{i} GROUP BY c),
centres{j} AS (SELECT m.c, coalesce(n.v, m.v) AS v FROM centres{i} m LEFT JOIN means{i} n ON m.c = n.c)"""
    steps = []
    for i in range(rounds):
        steps += [near.format(i=i), moved.format(i=i, j=i + 1)]
    steps.append(near.format(i=rounds))
    return f"""
WITH kept AS (
    SELECT vec_id, {_WHOLE} AS v FROM embeddings WHERE len(embedding) = 64 AND {_FINE}),
centres0 AS (
    SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1)::INTEGER AS c, v FROM kept
    QUALIFY c < {k}),{",".join(steps)}
SELECT vec_id, n.c AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY n.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM near{rounds} n JOIN centres{rounds} m ON n.c = m.c"""


OP13 = _op13()

ORACLE = {"op5_topk": OP5, "op11_divergence": OP11, "op12_near_vectors": OP12, "op13_centroids": OP13}
