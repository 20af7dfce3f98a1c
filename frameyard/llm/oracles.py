"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

from frameyard.llm.secret_scan import BASE, RULES

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = """
WITH RECURSIVE v AS (SELECT vec_id AS id, label, [CAST(a AS DOUBLE) for a in embedding] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT id, label, [a / sqrt(list_sum([b * b for b in e])) for a in e] AS e FROM v),
l AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.label = b.label AND a.id <> b.id AND list_inner_product(a.e, b.e) >= 0.93),
r(id, c) AS (SELECT id, id FROM v UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.id),
c AS (SELECT id, min(c) AS c FROM r GROUP BY id), n AS (SELECT a AS id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, vec_id) AS component_id, coalesce(c.c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.id = vec_id LEFT JOIN c ON c.id = vec_id
"""

_KINDS = " UNION ALL ".join(
    f"""SELECT rid, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(t, '{re}', 0) AS f, regexp_extract_all(t, '{re}', {r.group}) AS c, string_split_regex(t, '{re}') AS g FROM d"""
    for k, r in enumerate(RULES)
    for re in [r.regex.replace("'", "''")]
)
OP5 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents), m AS ({_KINDS}),
s AS (SELECT rid, k, kind, i, CAST(list_sum([length(x) for x in g[1:i]]) + coalesce(list_sum([length(x) for x in f[1:i - 1]]), 0) AS BIGINT) AS a, length(f[i]) AS n, length(c[i]) >= least AS ok
      FROM m, LATERAL (SELECT unnest(range(1, len(f) + 1)) AS i) WHERE len(f) > 0),
j AS (SELECT rid, {", ".join(f"count(*) FILTER (k = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))},
             string_agg(kind || ':' || a || ':' || a + n, ',' ORDER BY a, k) FILTER (k < {len(BASE)}) AS base, string_agg(kind || ':' || a || ':' || a + n, ',' ORDER BY a, k) AS spans
      FROM s WHERE ok GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN j USING (rid)
"""

OP6 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM w, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 1))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
r(id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.id), c AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, doc_id) AS component_id FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.id = doc_id
"""

_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP8 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
x AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS g FROM b, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 8))) AS i) WHERE len(w) > 0),
z AS (SELECT DISTINCT n FROM x),
p AS (SELECT rid, z.n, i, array_to_string(w[i:i + z.n - 1], ' ') AS g FROM d, z, LATERAL (SELECT unnest(range(1, len(w) - z.n + 2)) AS i) WHERE len(w) >= z.n),
h AS (SELECT rid, i, p.n, item FROM p JOIN x ON x.g = p.g AND x.n = p.n),
c AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS q FROM h) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""

#: Verdicts of the method itself: allow where no rule fits, block without a host.
OP10 = """
WITH r(verdict, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
                                 ('allow', 'com/fr/'), ('block', 'com/de/')),
u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT s.page_id, s.host, s.path, r.rule, r.verdict,
             row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS k
      FROM s LEFT JOIN r ON (s.host = split_part(r.rule, '/', 1) OR ends_with(s.host, '.' || split_part(r.rule, '/', 1)))
                        AND starts_with(s.path, substr(r.rule, position('/' IN r.rule))))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict FROM m WHERE k = 1
"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 30), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL), n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d), l AS (SELECT lang, sum(n) AS n FROM n GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c, 0) + 5) // (coalesce(n, 0) + 5 * v) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN n USING (lang, source)),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (s + 5) // (n + 5 * v) AS q FROM (SELECT lang, term, sum(c) AS s FROM c GROUP BY ALL) JOIN l USING (lang) JOIN v USING (lang)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
z AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM y UNION ALL FROM z)) WHERE part = 'pair' OR rank <= 50
"""
