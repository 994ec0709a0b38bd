"""SQL of the training-data queries that SQL can express, written apart from their code."""

from __future__ import annotations

EXACT_DEDUP = """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_KEPT_VECTORS = """
    kept AS MATERIALIZED (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
      FROM embeddings
      WHERE len(embedding) = 64
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY h) - 1 AS n, q
      FROM (SELECT q, sha256('3:' || vec_id::VARCHAR) AS h FROM kept ORDER BY h LIMIT 8))"""


def _nearest(name: str, centroids: str) -> str:
    """Every vector with 8 * distance + number of its nearest centroid."""
    gap = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return f"""
    {name} AS MATERIALIZED (
      SELECT v.vec_id, any_value(v.q) AS q, min({gap}::BIGINT * 8 + c.n) AS best
      FROM kept v CROSS JOIN {centroids} c GROUP BY v.vec_id)"""


def _moved(name: str, before: str, nearest: str) -> str:
    return f"""
    {name} AS MATERIALIZED (
      SELECT old.n, coalesce(new.q, old.q) AS q
      FROM {before} old LEFT JOIN (
        SELECT n, list(((s - ((s % m) + m) % m) // m)::BIGINT ORDER BY i) AS q
        FROM (SELECT best % 8 AS n, i, sum(x) AS s, count(*) AS m
              FROM (SELECT best, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM {nearest})
              GROUP BY ALL)
        GROUP BY n) new ON old.n = new.n)"""


def _clustering(rounds: int) -> str:
    steps = [_KEPT_VECTORS]
    for r in range(rounds):
        steps += [_nearest(f"a{r}", f"c{r}"), _moved(f"c{r + 1}", f"c{r}", f"a{r}")]
    steps.append(_nearest("final", f"c{rounds}"))
    return f"""
    WITH {",".join(steps)}
    SELECT f.vec_id, (best % 8)::INTEGER AS cluster, best // 8 AS distance,
           sum(best // 8) OVER (PARTITION BY best % 8)::BIGINT AS cluster_inertia,
           sum(best // 8) OVER ()::BIGINT AS inertia,
           sha256(array_to_string(c.q, ',')) AS centroid_sha256
    FROM final f JOIN c{rounds} c ON c.n = f.best % 8"""


CLUSTERING = _clustering(10)

# crc32 bit by bit, since the oracle has no function of it: of the id as decimal text
_CRC32 = """
    crc(c, i, v) AS (
      SELECT DISTINCT conv_id, 0, 4294967295::BIGINT FROM conversations WHERE conv_id IS NOT NULL
      UNION ALL
      SELECT c, i + 1, list_reduce([xor(v, ascii(substr(c::VARCHAR, i + 1, 1))), 1, 2, 3, 4, 5, 6, 7, 8],
                                    lambda x, k: xor(x >> 1, (x & 1) * 3988292384))
      FROM crc WHERE i < length(c::VARCHAR)),
    ids AS MATERIALIZED (
      SELECT c, c - c % 100 AS base, xor(v, 4294967295) % 6 AS h FROM crc WHERE i = length(c::VARCHAR))"""

PREFIX_TRIE = f"""
    WITH RECURSIVE {_CRC32},
    own AS MATERIALIZED (
      SELECT conv_id AS c,
             list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                  ORDER BY turn NULLS FIRST, coalesce(role, ''),
                  sha256(concat_ws(':', strlen(coalesce(role, '')), coalesce(role, ''), coalesce(text, '')))) AS turns
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    whole AS MATERIALIZED (
      SELECT i.c, list_concat(coalesce(b.turns[1:i.h], []), o.turns[i.h + 1:]) AS turns
      FROM ids i JOIN own o ON o.c = i.c LEFT JOIN own b ON b.c = i.base),
    path AS MATERIALIZED (
      SELECT c, d, sha256(turns[1:d]::JSON::VARCHAR) AS k, sha256(turns[1:d - 1]::JSON::VARCHAR) AS before,
             len(turns) AS n, length(turns[d].t) AS size
      FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM whole)),
    node AS MATERIALIZED (
      SELECT d, k, min(c) AS c, any_value(before) AS before, count(*) AS n_convs,
             coalesce((count(*) - 1) * any_value(size), 0) AS saved,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
      FROM path GROUP BY d, k),
    children AS (SELECT d - 1 AS d, before AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
    sums AS (
      SELECT p.d, p.k, sum(u.saved) AS saved, count(*) FILTER (w.n IS NULL) AS leaves
      FROM node u JOIN path p ON p.c = u.c AND p.d <= u.d LEFT JOIN children w ON w.d = u.d AND w.k = u.k
      GROUP BY ALL)
    SELECT v.c AS conv_id, v.d AS depth, up.c AS parent_conv_id, v.n_convs,
           coalesce(w.n, 0) AS n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, v.ends_sha256
    FROM node v JOIN sums s ON s.d = v.d AND s.k = v.k
    LEFT JOIN children w ON w.d = v.d AND w.k = v.k
    LEFT JOIN node up ON v.d > 0 AND up.d = v.d - 1 AND up.k = v.before"""

NEAR_VECTORS = """
    WITH RECURSIVE usable AS MATERIALIZED (
      SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size
      FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)
      WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)
        AND len(list_filter(e, lambda x: x <> 0)) > 0),
    link AS MATERIALIZED (
      SELECT a.vec_id AS a, b.vec_id AS b
      FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) >= 0.9 * a.size * b.size),
    reach(a, b) AS (
      SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    number AS (SELECT a, count(*) AS n FROM link GROUP BY a)
    SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
    FROM embeddings e JOIN least c ON c.a = e.vec_id LEFT JOIN number n ON n.a = e.vec_id"""

SUBSTRINGS = """
    WITH cut AS MATERIALIZED (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    place AS MATERIALIZED (
      SELECT doc_id, w[i] AS word, i, CASE WHEN i + 49 <= len(w) THEN sha256(array_to_string(w[i:i + 49], ' ')) END AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM cut)),
    first AS (SELECT k, min(doc_id) AS d FROM place WHERE k IS NOT NULL GROUP BY k),
    seen AS (SELECT p.doc_id, p.i, p.word, coalesce(f.d < p.doc_id, false) AS again FROM place p LEFT JOIN first f ON f.k = p.k),
    marked AS (
      SELECT doc_id, i, word, bool_or(again) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM seen),
    left_over AS (
      SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
      FROM marked GROUP BY doc_id)
    SELECT c.doc_id, len(c.w) AS n_words, coalesce(l.n_removed, 0) AS n_removed, sha256(coalesce(l.kept, '')) AS kept_sha256
    FROM cut c LEFT JOIN left_over l ON l.doc_id = c.doc_id"""

LLM_ORACLE = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op5_vectors": NEAR_VECTORS,
    "op7_substring_dedup": SUBSTRINGS,
    "op11_centroids": CLUSTERING,
    "op13_prefix_trie": PREFIX_TRIE,
}
