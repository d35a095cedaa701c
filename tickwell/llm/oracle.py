"""SQL of those queries that SQL can express."""

OP5 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
    ELSE array_to_string(words[i : i + 4], ' ') END AS shingle
  FROM split, unnest(range(1, greatest(len(words) - 3, 2))) AS t(i)
  WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared s JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * s.n >= 75 * (p.n + q.n - s.n)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS node, a AS other FROM edges
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
),
found AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(f.component, d.doc_id) AS component_id,
  d.doc_id = coalesce(f.component, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN found f ON f.node = d.doc_id
"""

# Whole-number components by part (p), place within the part (d) and vector.
_OP12_START = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
size AS (SELECT max(len(v)) // 16 AS s FROM kept),
comp AS (
  SELECT vec_id, (i - 1) // s AS p, (i - 1) % s AS d, v[i] AS x
  FROM kept, size, unnest(range(1, len(v) + 1)) AS t(i)
),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p, e, d, x FROM comp JOIN first USING (vec_id)),
"""

_OP12_NEAR = """
far{r} AS (
  SELECT c.vec_id, c.p, b.e, sum((c.x - b.x) * (c.x - b.x)) AS dist
  FROM comp c JOIN book{r} b ON b.p = c.p AND b.d = c.d
  GROUP BY c.vec_id, c.p, b.e
),
near{r} AS (
  SELECT vec_id, p, best.dist AS dist, best.e AS e
  FROM (SELECT vec_id, p, min(struct_pack(dist := dist, e := e)) AS best FROM far{r} GROUP BY vec_id, p)
),
"""

_OP12_MOVE = """
sums{r} AS (
  SELECT c.p, n.e, c.d, sum(c.x) AS s, count(*) AS n
  FROM comp c JOIN near{r} n ON n.vec_id = c.vec_id AND n.p = c.p
  GROUP BY c.p, n.e, c.d
),
book{next} AS (
  SELECT b.p, b.e, b.d, CASE WHEN s.n IS NULL THEN b.x ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x
  FROM book{r} b LEFT JOIN sums{r} s ON s.p = b.p AND s.e = b.e AND s.d = b.d
),
"""

_OP12_END = """
coded AS (
  SELECT vec_id, string_agg(format('{:02x}', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id
),
hash AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, d)) AS h FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), hash
"""

OP12 = (
    _OP12_START
    + "".join(_OP12_NEAR.format(r=r) + _OP12_MOVE.format(r=r, next=r + 1) for r in range(2))
    + _OP12_NEAR.format(r=2)
    + _OP12_END
)

ORACLE: dict[str, str] = {
    "op5_minhash_components": OP5,
    "op12_trie_codes": OP12,
}
