"""SQL for the operators that SQL can express. The others are tested against brute force in tests/llm."""

from __future__ import annotations

from .urlfilter import BLOCKED_LABELS, LOWER, PREFIX_RULES, UPPER

_WORDS = r"'[^\x20\x09-\x0D]+'"

SUBSTRING = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS key FROM p),
f AS (SELECT key, min(doc_id) AS m FROM k GROUP BY key),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM k JOIN f USING (key) WHERE m < doc_id),
r AS (SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, j: NOT list_contains(coalesce(gone, []), j)), ' ')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)"""

NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {_WORDS}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
b AS (SELECT x.doc_id AS x, y.doc_id AS y, count(*) AS i FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM b JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 80 * (nx.c + ny.c - i)),
pairs AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(a, z) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, pairs.y FROM r JOIN pairs ON r.z = pairs.x),
c AS (SELECT a AS doc_id, min(z) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n.c, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

_PLAIN = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

CONTAINED = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), {_PLAIN}) AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), {_PLAIN}) AS ws FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' '))) AS g FROM d),
s AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' '))) AS g FROM i),
n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id),
h AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN s USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment FROM h JOIN n USING (item_id) WHERE n_found >= 0.8 * n_item"""

URLS = rf"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
rules(verdict, rule, h, q) AS (VALUES {", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in PREFIX_RULES)}),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN regexp_matches(host || path, '^([^/]*[.-])?({"|".join(BLOCKED_LABELS)})[.-]') THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN m USING (page_id)"""
