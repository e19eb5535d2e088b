"""SQL counterparts of the text queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(between: str) -> str:
    return f"list_filter(string_split_regex({_LOWER}, '{between}'), lambda x: x <> '')"


_ALNUM = _words(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPACED = _words(r"[\x20\x09-\x0D]+")

DECONTAMINATE = rf"""
WITH low AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
itm AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM itm WHERE len(w) > 0)),
spot AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM low, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM spot JOIN win USING (win, n)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE low AS (SELECT doc_id, {_SPACED} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM low WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
links AS (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
                            GROUP BY 1, 2) JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
          WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM low UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
root AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
SELECT low.doc_id, coalesce(n, 0) AS n_shingles, component_id, low.doc_id = component_id AS kept
FROM low LEFT JOIN size USING (doc_id) JOIN root ON x = low.doc_id"""

TRIE = r"""
WITH orig AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                     coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT c, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                 lambda a, x: list_reduce(range(8), lambda b, k: CASE WHEN b % 2 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END, xor(a, x)),
                 CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h FROM (SELECT DISTINCT c FROM orig)),
turns AS (SELECT conv.c, 0 AS part, i, r, t FROM conv JOIN orig ON orig.c = conv.c - conv.c % 5 WHERE i <= h
          UNION ALL SELECT c, 1, i, r, t FROM orig JOIN conv USING (c) WHERE i > h),
seq AS (SELECT c, coalesce(list({'r': r, 't': t} ORDER BY part, i) FILTER (WHERE t IS NOT NULL), []) AS s FROM conv LEFT JOIN turns USING (c) GROUP BY c),
pre AS (SELECT c, len(s) AS n, d, list_slice(s, 1, d) AS p FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seq)),
node AS (SELECT d, p, min(c) AS o, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends
         FROM pre GROUP BY d, p),
own AS (SELECT pre.c, pre.d, node.o FROM pre JOIN node ON node.d = pre.d AND node.p = pre.p),
kid AS (SELECT u.o, u.d, count(*) AS n FROM node k JOIN own u ON u.c = k.o AND u.d = k.d - 1 GROUP BY 1, 2),
sums AS (SELECT u.o, u.d, sum((n_convs - 1) * CASE WHEN k.d = 0 THEN 0 ELSE strlen(k.p[-1].t) END) AS saved,
                count(*) FILTER (WHERE kid.n IS NULL) AS leaves
         FROM node k JOIN own u ON u.c = k.o AND u.d <= k.d LEFT JOIN kid ON kid.o = k.o AND kid.d = k.d GROUP BY 1, 2)
SELECT node.o AS conv_id, CAST(node.d AS BIGINT) AS depth, up.o AS parent_conv_id, n_convs, coalesce(kid.n, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM node JOIN sums ON sums.o = node.o AND sums.d = node.d LEFT JOIN kid ON kid.o = node.o AND kid.d = node.d
LEFT JOIN own up ON up.c = node.o AND up.d = node.d - 1"""

REPEATS = r"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
piece AS (SELECT k, doc_id, j, substr(x, 2 * j + 1, 2098) AS x FROM (SELECT k, doc_id, x, unnest(range(0, len(x) // 2, 1000)) AS j FROM doc WHERE doc_id IS NOT NULL)),
win AS (SELECT k, doc_id, j + i AS i, md5_number(substr(x, 2 * i + 1, 100)) AS s
        FROM (SELECT k, doc_id, j, x, unnest(range(0, least(1000, len(x) // 2 - 49))) AS i FROM piece)),
least AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT k, i, i - lag(i) OVER (PARTITION BY k ORDER BY i) > 50 AS apart FROM win JOIN least USING (s) WHERE doc_id > first),
span AS (SELECT k, g, min(i) AS a, max(i) + 50 AS b
         FROM (SELECT k, i, sum(coalesce(apart, TRUE)::INT) OVER (PARTITION BY k ORDER BY i) AS g FROM hit) GROUP BY k, g),
gap AS (SELECT k, b AS a, lead(a) OVER (PARTITION BY k ORDER BY a) AS b FROM (SELECT k, a, b FROM span UNION ALL SELECT k, -1, 0 FROM doc)),
kept AS (SELECT k, string_agg(substr(x, 2 * a + 1, 2 * (coalesce(b, len(x) // 2) - a)), '' ORDER BY a) AS x FROM gap JOIN doc USING (k) GROUP BY k)
SELECT doc_id, CAST(len(doc.x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.x)) AS kept_sha256
FROM doc JOIN kept USING (k) LEFT JOIN (SELECT k, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY k) USING (k)"""
