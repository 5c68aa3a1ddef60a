"""DuckDB SQL for the queries that SQL can express; column for column what the queries return."""

from __future__ import annotations

import string

LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
TOKENS = rf"regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+')"

def _repeats(name: str, length: int) -> str:
    """Runs of bytes in strings of the length that start more than once: doc_id, first byte a, byte behind the last z."""
    return f"""{name}_s AS (SELECT doc_id, unnest(range(0, n - {length - 1})) AS s, h FROM d WHERE n >= {length}),
{name}_k AS (SELECT doc_id, s, hash(substr(h, 2 * s + 1, {2 * length})) AS key FROM {name}_s),
{name}_r AS (SELECT doc_id, s FROM {name}_k WHERE key IN (SELECT key FROM {name}_k GROUP BY key HAVING count(*) > 1)),
{name}_i AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {length} THEN 0 ELSE 1 END AS new FROM {name}_r),
{name}_g AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM {name}_i),
{name} AS (SELECT doc_id, min(s) AS a, max(s) + {length} AS z FROM {name}_g GROUP BY doc_id, run)"""


SUFFIX_DEDUP = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
{_repeats("u", 400)},
p AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM u),
t AS (SELECT p.doc_id, sum(z - a) AS removed, count(*) AS spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(z) AS last FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""

DECONTAMINATE = f"""
WITH b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS key FROM iw),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
dw AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
hit AS (SELECT doc_id, i, k, item_id FROM (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS key FROM dw) JOIN win USING (k, key)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {TOKENS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5) UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 80 * (na.n + nb.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS node, doc_id AS origin FROM documents UNION SELECT e.b, r.origin FROM reach r JOIN e ON e.a = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(node) FROM reach WHERE origin = d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id)
"""
