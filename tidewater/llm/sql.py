"""DuckDB SQL for the queries that it can express exactly on whole tables."""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 100 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM sets
  UNION
  SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node
),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON l.node = s.doc_id
"""

PASSAGES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
windows AS (
  SELECT r, p, array_to_string(w[p : p + 34], ' ') AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM docs WHERE len(w) >= 35)
),
again AS (SELECT r, p FROM windows WHERE x IN (SELECT x FROM windows GROUP BY x HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS i FROM again),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM docs),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.r = d.r
"""

MANIFEST = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS a,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS z,
         -- crc32 of the decimal id, bit by bit
         coalesce(xor(list_reduce(
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
           lambda crc, byte: list_reduce(range(8), lambda s, i: xor(s >> 1, (s & 1) * 3988292384), xor(crc, byte)),
           CAST(4294967295 AS BIGINT)), 4294967295) % 7 = 0, false) AS hit
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM (
    SELECT doc_id, coalesce('v' || lang, '') AS lang,
           sha256(a || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || z) AS leaf,
           sha256(a || CASE WHEN n_chars IS NULL THEN '-' WHEN hit THEN strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || n_chars + 1
                       ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || z) AS tampered
    FROM fields
  )
),
nodes AS (
  SELECT lang, CAST(0 AS BIGINT) AS level, CAST(i AS BIGINT) AS i, leaf AS h, CAST(n AS BIGINT) AS n FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2, n
),
subroots AS (SELECT lang, h, level AS height, row_number() OVER (ORDER BY lang) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT CAST(0 AS BIGINT) AS level, CAST(i AS BIGINT) AS i, h, CAST(n AS BIGINT) AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, i // 2, n
),
-- all nodes of the way up, those over the subroots after a language's own
way AS (
  SELECT lang, level, i, h FROM nodes WHERE n > 1
  UNION ALL
  SELECT s.lang, s.height + t.level, t.i, t.h FROM subroots s, tops t WHERE t.n > 1
),
up AS (
  SELECT l.lang, l.i AS leaf_i, k.level, CASE WHEN k.level < s.height THEN l.i >> k.level ELSE s.i >> (k.level - s.height) END AS i
  FROM leaves l JOIN subroots s USING (lang) JOIN (SELECT DISTINCT lang, level FROM way) k ON k.lang = l.lang
),
steps AS (SELECT u.lang, u.leaf_i, u.level, u.i, w.h FROM up u LEFT JOIN way w ON w.lang = u.lang AND w.level = u.level AND w.i = xor(u.i, 1)),
proofs AS (SELECT lang, leaf_i, sha256(coalesce(string_agg(h, '' ORDER BY level), '')) AS proof_sha256 FROM steps GROUP BY lang, leaf_i),
folds AS (
  SELECT lang, i AS leaf_i, CAST(0 AS BIGINT) AS level, tampered AS h FROM leaves
  UNION ALL
  SELECT f.lang, f.leaf_i, f.level + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.i % 2 = 1 THEN s.h || f.h ELSE f.h || s.h END)
  FROM folds f JOIN steps s ON s.lang = f.lang AND s.leaf_i = f.leaf_i AND s.level = f.level
),
folded AS (SELECT lang, leaf_i, arg_max(h, level) AS h FROM folds GROUP BY lang, leaf_i)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM leaves l JOIN subroots s USING (lang) JOIN (SELECT h FROM tops WHERE n = 1) r ON true
JOIN folded f ON f.lang = l.lang AND f.leaf_i = l.i LEFT JOIN proofs p ON p.lang = l.lang AND p.leaf_i = l.i
"""


def _centroids(k: int = 16, rounds: int = 3) -> str:
    """Each round is the same two steps: the nearest centroid, the floor of the mean."""
    parts = [
        f"""WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, x AS c
  FROM (SELECT * FROM v ORDER BY sha256('1:' || vec_id) LIMIT {k})
)"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
    SELECT r, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM v, c{i}
  ) GROUP BY r
)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS (
  SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN (
    SELECT cluster, list(m ORDER BY dim) AS c FROM (
      SELECT cluster, dim, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
      FROM (SELECT a.cluster, unnest(v.x) AS x, unnest(range(64)) AS dim FROM a{i} a JOIN v USING (r)) GROUP BY cluster, dim
    ) GROUP BY cluster
  ) m USING (cluster)
)"""
            )
    return ",\n".join(parts) + f"""
SELECT v.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (r) JOIN c{rounds} c USING (cluster)
"""


CENTROIDS = _centroids()


def registered() -> dict[str, str]:
    return {
        "op6_topk": TOP_K, "op8_near_duplicates": NEAR_DUPLICATES, "op11_passages": PASSAGES, "op12_manifest": MANIFEST,
        "op13_centroids": CENTROIDS,
    }
