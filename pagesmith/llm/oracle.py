"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_VALUE = r"""\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))"""


def _attr(tag: str, name: str) -> str:
    return "concat(" + ", ".join(rf"regexp_extract({tag}, '(?is)\b{name}{_VALUE}', {i})" for i in (1, 2, 3)) + ")"


def _parts(url: str) -> str:
    return rf"""translate(regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^?#]*(\?[^#]*)', 1) AS query"""


ORACLE["op2_url_filters"] = rf"""
WITH RECURSIVE rules(rule, allow) AS (VALUES ('com/', true), ('example.com/en/', false), ('www.example.com/en/', true),
    ('net/es/', false), ('net/fr/', false)),
p AS (SELECT page_id, url, html, {_parts('url')} FROM pages),
tags AS (SELECT *, regexp_extract(coalesce(html, ''), '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0) AS link,
    regexp_extract(coalesce(html, ''), '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0) AS meta FROM p WHERE url LIKE '%://%'),
hrefs AS (SELECT url, host, path, query, replace(trim(h), '&amp;', '&') AS h FROM (
    SELECT *, {_attr('link', 'href')} AS h FROM tags
    UNION ALL SELECT *, regexp_extract({_attr('meta', 'content')}, '(?is)\burl\s*=\s*[''"]?([^''"]*)', 1) FROM tags)),
edges AS (SELECT host || path || query AS a, CASE WHEN h = '' THEN NULL WHEN h LIKE '%://%' THEN h WHEN h LIKE '//%' THEN 'http:' || h
    WHEN h LIKE '/%' THEN 'http://' || host || h
    ELSE 'http://' || host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || h END AS dst, host, path FROM hrefs),
named AS (SELECT a, host AS ahost, path AS apath, {_parts('dst')} FROM edges WHERE dst LIKE '%://%'),
pairs AS (SELECT a, host || path || query AS b, ahost, apath, host, path FROM named),
sides AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(x, y) AS (SELECT a, a FROM sides UNION SELECT r.x, s.b FROM reach r JOIN sides s ON r.y = s.a),
nodes AS (SELECT a AS node, ahost AS host, apath AS path FROM pairs UNION SELECT b, host, path FROM pairs),
sites AS (SELECT host, path FROM p UNION SELECT host, path FROM nodes),
fits AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(allow, length(rule)) AS allow FROM sites, rules
    WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
      AND starts_with(path, substr(rule, instr(rule, '/'))) GROUP BY ALL),
carried AS (SELECT r.x AS node, bool_or(f.allow) AS alias_allow FROM reach r JOIN nodes n ON r.y = n.node
    JOIN fits f ON n.host = f.host AND n.path = f.path GROUP BY 1)
SELECT page_id, p.host, p.path, rule, CASE WHEN coalesce(allow, alias_allow, true) THEN 'allow' ELSE 'block' END AS verdict
FROM p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path LEFT JOIN carried c ON c.node = p.host || p.path || p.query
"""

ORACLE["op7_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM g),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM win) WHERE k > 1),
cov AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY 1),
s AS (SELECT doc_id, t, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls) AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN cov USING (r)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 50 * n_lines
        OR word_chars < 2 * n_words OR word_chars > 20 * n_words
        OR 100 * length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) > 50 * length(regexp_replace(t, '[^\p{L}]+', '', 'g'))) AS kept
FROM b
"""

ORACLE["op8_line_dedup"] = r"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i AS pos, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM s)),
w AS (SELECT *, list_distinct(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS ws FROM l),
f AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth FROM w WHERE len(ws) > 0),
d AS (SELECT row_number() OVER (ORDER BY doc_id, pos) AS lid, line, ws, len(ws) AS n FROM f WHERE nth = 1),
t AS (SELECT lid, n, unnest(ws) AS tok FROM d),
c AS (SELECT tok, count(*) AS k FROM t GROUP BY tok),
p AS (SELECT lid, n, tok FROM t JOIN c USING (tok) QUALIFY row_number() OVER (PARTITION BY lid ORDER BY k, tok) <= n - (4 * n + 4) // 5 + 1),
cand AS (SELECT DISTINCT a.lid AS a, b.lid AS b FROM p a JOIN p b ON a.tok = b.tok AND a.lid < b.lid
    AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
gone AS (SELECT DISTINCT y.line FROM cand JOIN d x ON cand.a = x.lid JOIN d y ON cand.b = y.lid
    WHERE 9 * len(list_intersect(x.ws, y.ws)) >= 4 * (x.n + y.n)),
away AS (SELECT doc_id, pos FROM f WHERE nth > 1 OR line IN (SELECT line FROM gone)),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN away USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM away GROUP BY doc_id)
SELECT documents.doc_id, CASE WHEN documents.text IS NOT NULL THEN coalesce(kept.text, '') END AS text, coalesce(n.n, 0)::BIGINT AS n_removed
FROM documents LEFT JOIN kept ON documents.doc_id = kept.doc_id LEFT JOIN n ON documents.doc_id = n.doc_id
"""


ORACLE["op11_repeated_passages"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT r, doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
m AS (SELECT r, doc_id, i, min((doc_id, i)) OVER (PARTITION BY g) AS f FROM w),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS i FROM m WHERE (doc_id, i) > f),
word AS (SELECT r, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)
"""

ORACLE["op12_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS ls, [('0x' || substr(h, 8 * k + 1, 8))::BIGINT for k in range(4)] AS h FROM d),
c AS (SELECT doc_id, t, ls, len(ls) AS n, least(h[1] % (len(ls) + 1), h[2] % (len(ls) + 1)) AS lo, greatest(h[1] % (len(ls) + 1), h[2] % (len(ls) + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, n, form, array_to_string(ls[1:lo], '') AS pre, array_to_string(ls[lo + 1:hi], '') AS mid, array_to_string(ls[hi + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""

#: CRC-32 of one byte, by the reflected polynomial.
_CRC = [0] * 256
for _x in range(256):
    _CRC[_x] = _x
    for _ in range(8):
        _CRC[_x] = (_CRC[_x] >> 1) ^ (0xEDB88320 if _CRC[_x] & 1 else 0)

ORACLE["op13_importance_resampling"] = rf"""
WITH tab AS (SELECT {_CRC}::BIGINT[] AS t),
folded(side, r, id, text) AS (
    SELECT 0, row_number() OVER (), doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM documents
    UNION ALL SELECT 1, row_number() OVER (), NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT side, r, id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM folded),
f AS (SELECT side, r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS g FROM w),
n AS (SELECT side, r, g, count(*) AS k FROM f GROUP BY ALL),
x AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM n)),
b AS (SELECT g, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS b FROM x, tab),
c AS (SELECT side, r, b, sum(k)::BIGINT AS k FROM n JOIN b USING (g) GROUP BY ALL),
s AS (SELECT b, coalesce(sum(k) FILTER (side = 0), 0)::BIGINT AS s, coalesce(sum(k) FILTER (side = 1), 0)::BIGINT AS t FROM c GROUP BY b),
a AS (SELECT sum(s)::BIGINT AS sn, sum(t)::BIGINT AS tn FROM s),
gain AS (SELECT b, floor(1000 * ln(((t + 1) * (sn + 10000))::DOUBLE / ((s + 1) * (tn + 10000))::DOUBLE))::BIGINT AS g FROM s, a),
d AS (SELECT r, sum(k)::BIGINT AS n_features, sum(k * g)::BIGINT AS weight FROM c JOIN gain USING (b) WHERE side = 0 GROUP BY r),
e AS (SELECT id AS doc_id, len(ws) AS nw, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM w LEFT JOIN d USING (r) WHERE side = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY nw >= 20 ORDER BY score DESC, doc_id) AS p, count(*) FILTER (nw >= 20) OVER () AS fit FROM e)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN nw >= 20 AND p <= 5 * fit // 100 THEN p END AS rank FROM o
"""
