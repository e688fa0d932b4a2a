"""SQL (DuckDB) that queries of this subpackage must equal, written from their contracts and not from their plans."""

from __future__ import annotations

from cairn.llm import url_rules
from cairn.llm.lines import OP10_SQL

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
#: The least id that links lead to, from the pairs ``link(a, b)``, both ways.
_REACH = """reach AS (SELECT a AS id, a AS other FROM link UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.other = link.a),
lowest AS (SELECT id, min(other) AS component FROM reach GROUP BY id)"""

OP3_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
u AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS size FROM v),
link AS (SELECT p.vec_id AS a, q.vec_id AS b FROM u p JOIN u q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_inner_product(p.x, q.x) >= 0.95 * p.size * q.size),
{_REACH}, n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN lowest ON vec_id = lowest.id LEFT JOIN n ON vec_id = n.a
"""

OP4_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_FOLD)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [list_aggregate(w, 'string_agg', ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
link AS (SELECT p.doc_id AS a, q.doc_id AS b FROM e p JOIN e q ON p.x = q.x AND p.doc_id <> q.doc_id AND 10 * least(p.n, q.n) >= 9 * greatest(p.n, q.n)
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
{_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id FROM s LEFT JOIN lowest ON doc_id = id
"""

OP9_SQL = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS pos, w FROM w WHERE len(w) >= 35),
k AS (SELECT doc_id, pos, md5(array_to_string(w[pos : pos + 34], ' ')) AS k FROM g),
twice AS (SELECT k FROM k GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 35)) AS pos FROM k SEMI JOIN twice USING (k)),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_rules.RULES)
#: A url's parts and tokens as ``url_rules`` has them; the mining is all combinations of a labelled url's items.
OP8_SQL = rf"""
WITH r(v, h, p) AS (VALUES {_RULES}),
a AS (SELECT DISTINCT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages WHERE url IS NOT NULL),
b AS (SELECT url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
u AS (SELECT url, host, path, string_split(host, '.') AS l FROM b WHERE host <> ''),
d AS (SELECT url, host, path, list_transform(range(1, len(l) + 1), lambda i: array_to_string(l[i : len(l)], '.')) AS domains FROM u),
f AS (SELECT url, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS rule_verdict FROM d, r WHERE list_contains(domains, h) AND starts_with(path, p) GROUP BY url),
s AS (SELECT url, domains, path, list_filter(string_split(translate(path, '{url_rules.UPPER}', '{url_rules.LOWER}'), '/'), lambda x: x <> '') AS segments,
  list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '') AS query FROM d),
t AS (SELECT url, list_distinct(['s:' || string_split(lower(url), '://')[1], 'x:' || regexp_extract(path, '\.([A-Za-z0-9]+)/?$', 1)] || list_transform(domains, lambda x: 'd:' || x)
  || list_transform(range(1, len(segments) + 1), lambda i: 'p' || i || ':' || regexp_replace(segments[i], '[0-9]+', '#', 'g')) || list_transform(query, lambda x: 'q:' || string_split(x, '=')[1])) AS tokens FROM s),
lab AS (SELECT url, rule_verdict = 'block' AS block FROM f WHERE CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % 5 <> 1),
x AS (SELECT url, block, unnest(tokens) AS token FROM lab JOIN t USING (url)),
same AS (SELECT token, list(url ORDER BY url) AS urls FROM x GROUP BY token HAVING count(*) FILTER (block) >= {url_rules.LEAST}),
chosen AS (SELECT min(token) AS token FROM same GROUP BY urls),
items AS (SELECT url, block, list(token ORDER BY token) AS items FROM x SEMI JOIN chosen USING (token) GROUP BY url, block),
subsets AS (SELECT block, list_filter(items, lambda y, i: (bits >> (i - 1)) & 1 = 1) AS tokens FROM (SELECT block, items, unnest(range(1, CAST(1 AS BIGINT) << len(items))) AS bits FROM items)),
total AS (SELECT count(*) AS n FROM lab),
mined AS (SELECT tokens, count(*) FILTER (block) / count(*) AS confidence FROM subsets, total GROUP BY tokens, n
  HAVING count(*) FILTER (block) >= greatest(ceil({url_rules.MIN_SUPPORT} * n), {url_rules.LEAST}) AND count(*) FILTER (block) / count(*) >= {url_rules.MIN_CONFIDENCE}),
fired AS (SELECT url, max(confidence) AS confidence FROM t, mined WHERE list_has_all(t.tokens, mined.tokens) GROUP BY url)
SELECT page_id, coalesce(u.host, '') AS host, coalesce(b.path, '') AS path, f.rule, CASE WHEN f.rule IS NOT NULL THEN f.rule_verdict WHEN fired.url IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, fired.confidence
FROM pages LEFT JOIN b ON pages.url = b.url LEFT JOIN u ON pages.url = u.url LEFT JOIN f ON pages.url = f.url LEFT JOIN fired ON pages.url = fired.url
"""

ORACLE_SQL = {
    "op3_embedding_dedup": OP3_SQL,
    "op4_ngram_jaccard": OP4_SQL,
    "op8_url_filter": OP8_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
}
