"""DuckDB SQL of the results that SQL can state."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD_JOIN = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
      FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p WHERE 100 * c >= 90 * (na + nb - c)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id
FROM s LEFT JOIN m ON s.doc_id = m.a
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, w, least(13, len(w)) AS l FROM b WHERE len(w) > 0),
v AS (SELECT DISTINCT item_id, l, array_to_string(w[k:k + l - 1], ' ') AS x
      FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS k FROM i)),
t AS (SELECT DISTINCT l FROM i),
o AS (SELECT doc_id, l, k, array_to_string(w[k:k + l - 1], ' ') AS x
      FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS k FROM d, t)),
f AS (SELECT doc_id, item_id, o.l, k FROM o JOIN v ON o.l = v.l AND o.x = v.x),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + l)) AS q FROM f) GROUP BY doc_id),
g AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)
"""
