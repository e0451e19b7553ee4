"""SQL for the operators that SQL can express, for DuckDB on small tables."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.n > 0 AND b.n > 0 AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1) USING (vec_id) LEFT JOIN (SELECT a AS vec_id, min(b) AS low FROM reach GROUP BY 1) USING (vec_id)
"""

OP7_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(w[i:i + 4]) AS h FROM d, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) t(i)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_sets AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM both_sets JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY 1) USING (doc_id)
"""

_WORDS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP8_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark),
bw AS MATERIALIZED (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, (SELECT DISTINCT n FROM bw), unnest(range(1, greatest(len(w) - n + 2, 1))) t(i)),
hits AS MATERIALIZED (SELECT r, i, n, item FROM dw JOIN bw USING (n, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) u(p) GROUP BY 1),
items AS (SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS names FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
