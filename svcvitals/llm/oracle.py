"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP10 = """
WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
r(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
j AS (SELECT p.page_id, host, path, h || r.p AS rule, verdict,
             row_number() OVER (PARTITION BY p.page_id ORDER BY strlen(h || r.p) DESC NULLS LAST) AS k
      FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE k = 1
"""

OP3 = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
      FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP5 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * k >= 85 * (ca.n + cb.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN c USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) m USING (doc_id)
"""

OP7 = r"""
WITH low(kind, id, t) AS (
    SELECT 'd', CAST(doc_id AS VARCHAR), translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM documents
    UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
pat AS (SELECT DISTINCT id AS item, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS p
        FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM w WHERE kind = 'b' AND len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM pat),
win AS (SELECT id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS p
        FROM (SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, lens WHERE kind = 'd' AND len(ws) >= n)),
hits AS (SELECT id, i, win.n, item FROM win JOIN pat ON pat.p = win.p AND pat.n = win.n),
hw AS (SELECT id, count(DISTINCT k) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY id),
hi AS (SELECT id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h FROM (SELECT DISTINCT id, item FROM hits) GROUP BY id)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hw USING (id) LEFT JOIN hi USING (id) WHERE kind = 'd'
"""

OP9 = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc_id
"""

OP12 = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
l AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM l),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
i AS (SELECT t.doc_id, t.term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))) AS impact
      FROM t JOIN f USING (term) JOIN l USING (doc_id), s WHERE t.term IN (SELECT term FROM q)),
r AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""

ORACLE_SQL = {"op3_exact_topk": OP3, "op5_ngram_jaccard_join": OP5, "op7_benchmark_decontamination": OP7, "op9_line_dedup": OP9, "op10_url_filter": OP10,
              "op12_ranked_search": OP12}
