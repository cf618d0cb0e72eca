"""DuckDB SQL for the queries that SQL can express, written apart from the Spark plans."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_OP4 = rf"""WITH RECURSIVE d AS (
 SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_SPACED}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
 FROM d, unnest(range(1, greatest(len(w), 2))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM d
 UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)"""

_OP6 = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS g FROM d, unnest(range(1, len(w) - 33)) t(i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM again)),
words AS (SELECT doc_id, j, w[j] AS word FROM d, unnest(range(1, len(w) + 1)) t(j)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
 FROM words LEFT JOIN gone USING (doc_id, j) WHERE gone.j IS NULL GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
 sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

_OP7 = """WITH v AS (
 SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
 WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
 FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5"""

_OP8 = rf"""WITH u AS (
 SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
c AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/index)?(\.html?)?/*$', '') AS key FROM h),
listed AS (SELECT DISTINCT key FROM c WHERE host <> '' AND regexp_matches(host, '(^|[.-])(spam|pills|casino|bets|ads)[.-]')),
rules(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
 ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (SELECT page_id, rule_host || rule_path AS rule, verdict FROM c JOIN rules
 ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN listed.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
 listed.key IS NOT NULL AS listed FROM c LEFT JOIN fits USING (page_id) LEFT JOIN listed ON c.key = listed.key AND host <> ''"""

_OP10 = rf"""WITH d AS (
 SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM benchmark),
item_windows AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS g
 FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM item_windows),
doc_windows AS (SELECT doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
 FROM d, sizes, unnest(range(1, len(w) - m + 2)) t(i) WHERE len(w) >= m),
hits AS (SELECT doc_id, i, m, item_id FROM doc_windows JOIN item_windows USING (m, g)),
places AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP11 = rf"""WITH RECURSIVE d AS (
 SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_SPACED}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
 FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM d
 UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least LEFT JOIN n USING (doc_id)"""

#: crc32 of a decimal number: its ASCII digits through the reflected polynomial, bit by bit.
_CRC = """xor(list_reduce(list_transform(range(1, CAST(length(CAST({0} AS VARCHAR)) AS BIGINT) + 1), lambda i: CAST(ascii(substr(CAST({0} AS VARCHAR), i, 1)) AS BIGINT)),
 lambda crc, byte: list_reduce(range(1, 9), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)), 4294967295), 4294967295)"""

_OP12 = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w, {_CRC.format("doc_id")} AS h FROM documents),
s AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AS again, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS e FROM d),
places AS (SELECT doc_id, n, i, w[1 + CASE WHEN again AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + e)) ELSE i END] AS word
 FROM s, unnest(range(0, n)) t(i)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM places x JOIN places y ON x.doc_id = y.doc_id AND x.word = y.word
 AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS q FROM stretches GROUP BY doc_id, start, length),
of_doc AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed,
 first(start ORDER BY length / q DESC, start, q) AS start, first(length ORDER BY length / q DESC, start, q) AS length,
 first(q ORDER BY length / q DESC, start, q) AS q FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM places LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
 CAST(1000 * length // q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN of_doc USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_OP13 = rf"""WITH RECURSIVE t AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
 len(regexp_extract_all(coalesce(text, ''), {_SPACED})) AS words, turn FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(name ORDER BY turn NULLS FIRST, name) AS names, list(words ORDER BY turn NULLS FIRST, name) AS words FROM t GROUP BY conv_id),
h AS (SELECT *, CAST({_CRC.format("conv_id")} % 4 AS BIGINT) AS h FROM own),
built AS (SELECT h.conv_id, coalesce(b.names, [])[1:h] || h.names[h + 1:] AS names, coalesce(b.words, [])[1:h] || h.words[h + 1:] AS words
 FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
prefixes AS (SELECT conv_id, d, array_to_string(names[1:d], '') AS key, words[d] AS words, d = len(names) AS ends,
 CASE WHEN d > 0 THEN array_to_string(names[1:d - 1], '') END AS parent FROM built, unnest(range(0, len(names) + 1)) u(d)),
nodes AS (SELECT d, key, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM prefixes GROUP BY d, key),
children AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (key)),
up(key, parent, leaf, saved) AS (SELECT key, parent, CAST(n_children = 0 AS BIGINT), CAST((n - 1) * coalesce(words, 0) AS BIGINT) FROM counted
 UNION ALL SELECT p.key, p.parent, up.leaf, up.saved FROM up JOIN counted p ON p.key = up.parent),
sums AS (SELECT key, sum(leaf) AS n_leaves, sum(saved) AS saved FROM up GROUP BY key)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
 CAST(saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums USING (key) LEFT JOIN nodes p ON p.key = c.parent"""

ORACLE_SQL: dict[str, str] = {
    "op4_bbit_minhash": _OP4,
    "op6_recompression": _OP6,
    "op7_kd_trees": _OP7,
    "op8_url_bloom": _OP8,
    "op10_winnowing": _OP10,
    "op11_prefix_join": _OP11,
    "op12_periodic_runs": _OP12,
    "op13_prefix_trie": _OP13,
}
