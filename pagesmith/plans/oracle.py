"""DuckDB SQL for every registry key: the same fixtures and the same rules, written as plain SQL
over the pre-registered test tables.  Used only to check the Spark results."""

from __future__ import annotations

from pagesmith.functions.content import DEFAULT_EXT, EXTENSION_MAP, mime_table
from pagesmith.functions.text import ISO_LANGUAGE_NAMES, STRIP_PATTERN, WHITESPACE_CLASS
from pagesmith.plans.fixtures import EVENT_CONTENT_TYPE

SITE = "https://portal.example.org"
KEPT = "('french', 'german')"
MAX_ATTEMPTS = 4
_ASCII_SPACE = r" \t\n\r\x0b\x0c\x1c-\x1f"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def san(x: str) -> str:
    return f"replace(replace(regexp_replace({x}, {_q(STRIP_PATTERN)}, '', 'g'), chr(10), ' '), chr(9), ' ')"


def slug(x: str) -> str:
    a = rf"regexp_replace(strip_accents(coalesce({x}, 'None')), '[^\x00-\x7f]', '', 'g')"
    k = f"regexp_replace(lower({a}), '[^a-z0-9_{_ASCII_SPACE}-]', '', 'g')"
    d = f"regexp_replace({k}, '[{_ASCII_SPACE}-]+', '-', 'g')"
    return rf"regexp_replace({d}, '\A[-_]+|[-_]+\z', '', 'g')"


def uslug(x: str) -> str:
    ws = WHITESPACE_CLASS[1:-1]
    k = f"regexp_replace(lower(nfc_normalize(coalesce({x}, 'None'))), '[^\\p{{L}}\\p{{N}}_{ws}-]', '', 'g')"
    d = f"regexp_replace({k}, '[{ws}-]+', '-', 'g')"
    return rf"regexp_replace({d}, '\A[-_]+|[-_]+\z', '', 'g')"


def label(x: str) -> str:
    iso = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in ISO_LANGUAGE_NAMES.items())
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN contains({x}, '.') THEN lower(split_part({x}, '.', 2)) "
            f"ELSE coalesce(CASE lower({x}) {iso} END, lower({x})) END")


def ext(ct: str) -> str:
    exact = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in EXTENSION_MAP.items())
    mime = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mime_table().items())
    return (f"CASE WHEN {ct} IS NULL THEN NULL ELSE coalesce(CASE {ct} {exact} END, "
            f"CASE lower({ct}) {mime} END, {_q(DEFAULT_EXT)}) END")


def unesc(x: str) -> str:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {_q(a)}, {_q(b)})"
    return x


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


FIRST_LINE = "split_part(text, chr(10), 1)"
EVENT_CT = "CASE event_type " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in EVENT_CONTENT_TYPE.items()) + " END"

CTES = {
    "publishers": """SELECT s.s_suppkey, s.s_nationkey, s.s_name AS name,
        '/en/search?q=&supplier=' || CAST(s.s_suppkey AS VARCHAR) AS url,
        CAST(coalesce(l.n, 0) AS INTEGER) AS article_count
      FROM supplier s LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey) l
        ON s.s_suppkey = l.l_suppkey""",
    "articles_lang": f"""SELECT doc_id, {san(FIRST_LINE)} AS title, '/doc/' || CAST(doc_id AS VARCHAR) AS info_url,
        {san('text')} AS abstract, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE {label('lang')} END AS language
      FROM documents""",
    "cards": """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE title END AS title,
        CASE WHEN doc_id % 7 = 0 THEN NULL ELSE info_url END AS info_url,
        CASE WHEN doc_id % 11 = 0 THEN NULL ELSE abstract END AS abstract FROM articles_lang""",
    "attempts": f"""SELECT event_id AS id,
        'https://example.org/' || CAST(user_id AS VARCHAR) || CASE WHEN event_id % 2 = 1 THEN '/' ELSE '' END AS url,
        ts AS fetched_at, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
        {EVENT_CT} AS content_type, props FROM events""",
    "local_files": f"SELECT page_id, {slug('url')} || '.html' AS name FROM pages",
    "remote_objects": """SELECT 'corpus/' || name AS name FROM local_files WHERE page_id % 3 = 0
      UNION ALL SELECT 'corpus/sub/' || name FROM local_files WHERE page_id % 50 = 0
      UNION ALL SELECT * FROM (VALUES ('corpus/'), ('corpus/sub/'), ('toplevel.html'), ('corpus/missing-object.html')) v(name)""",
    "remote_names": """SELECT string_split(name, '/')[-1] AS name, count(*) AS remote_copies FROM remote_objects
      WHERE contains(name, '/') AND NOT ends_with(name, '/') GROUP BY 1""",
    "page_articles": f"""SELECT page_id, url,
        {san(unesc(strip_tags("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")))} AS title,
        {san(unesc(strip_tags("regexp_extract(html, '(?s)<article>.*?<p>(.*)</article>', 1)")))} AS abstract
      FROM pages""",
    "ranked": f"""SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at, id) AS attempt_no FROM attempts""",
    "named_ok": f"SELECT *, {slug('url')} || {ext('content_type')} AS object_name FROM attempts WHERE status = 200",
    "store_plan": f"""SELECT * FROM (SELECT *, {slug('url')} || {ext('content_type')} AS object_name FROM ranked
        WHERE attempt_no <= {MAX_ATTEMPTS} AND status = 200
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY attempt_no) = 1)
      QUALIFY row_number() OVER (PARTITION BY object_name ORDER BY fetched_at DESC, id DESC) = 1""",
    "pubpages": f"""SELECT url, unnest(generate_series(1, CAST(ceil(article_count / 24) AS BIGINT))) AS page
      FROM publishers WHERE article_count >= 1 AND len(string_split(url, '/search')) = 2""",
}
CTES["html_files"] = """SELECT CASE WHEN page_id % 5 = 0 THEN '_p' ELSE 'p' END || page_id || '.html' AS file_name, page_id, html FROM pages"""
CTES["link_files"] = """SELECT CASE WHEN blk % 6 = 5 THEN '_b' ELSE 'b' END || blk || '.json' AS file_name, blk % 6 AS kind, pos, url FROM (
    SELECT page_id // 25 AS blk, row_number() OVER (PARTITION BY page_id // 25 ORDER BY page_id) - 1 AS pos, url || '.pdf' AS url FROM pages)"""
DEPS = {
    "cards": ["articles_lang"], "remote_objects": ["local_files"], "remote_names": ["remote_objects"],
    "ranked": ["attempts"], "named_ok": ["attempts"], "store_plan": ["ranked"],
    "pubpages": ["publishers"],
}


BY_BLOCK = "SELECT id, url || '/' || CAST(id // 400 AS VARCHAR) AS url, fetched_at, status FROM attempts"


def outcome_sql(src: str) -> str:
    return f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at, id) AS attempt_no FROM ({src})),
      lim AS (SELECT * FROM r WHERE attempt_no <= {MAX_ATTEMPTS}),
      g AS (SELECT url, count(*) AS seen, min(attempt_no) FILTER (WHERE status = 200) AS ok_no FROM lim GROUP BY url),
      f AS (SELECT url, id AS success_id, fetched_at AS succeeded_at FROM lim WHERE status = 200
            QUALIFY row_number() OVER (PARTITION BY url ORDER BY attempt_no) = 1)
    SELECT g.url, CASE WHEN ok_no IS NOT NULL THEN 'succeeded' WHEN seen >= {MAX_ATTEMPTS} THEN 'failed'
        ELSE 'pending' END AS state, CAST(coalesce(ok_no, seen) AS INTEGER) AS attempts_used,
        f.success_id, epoch_us(f.succeeded_at) AS succeeded_at_us
    FROM g LEFT JOIN f USING (url)"""


def run_plan(which: str, run: int) -> str:
    """What one run over some of the attempts stores."""
    return f"""SELECT *, {run} AS run FROM (SELECT *, {slug('url')} || {ext('content_type')} AS object_name FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at, id) AS attempt_no FROM attempts WHERE {which})
        WHERE attempt_no <= {MAX_ATTEMPTS} AND status = 200 QUALIFY row_number() OVER (PARTITION BY url ORDER BY attempt_no) = 1)
        QUALIFY row_number() OVER (PARTITION BY object_name ORDER BY fetched_at DESC, id DESC) = 1"""


def detect_ctes(src: str, key: str, text: str) -> str:
    grams = "unnest(list_transform(range(1, len(cs) - 1), lambda i: cs[i] || cs[i + 1] || cs[i + 2]))"
    return f"""train AS (SELECT lang, regexp_extract_all(lower(text), '(?s).') AS cs FROM documents
        WHERE text IS NOT NULL AND lang IS NOT NULL),
      tg AS (SELECT lang, {grams} AS g FROM train),
      cnt AS (SELECT lang, g, count(*) AS c FROM tg GROUP BY lang, g),
      tot AS (SELECT lang, sum(c) AS t FROM cnt GROUP BY lang),
      voc AS (SELECT count(DISTINCT g) AS v FROM cnt),
      w0 AS (SELECT lang, CAST(round(1000.0 * ln(CAST(1 AS DOUBLE) / CAST(t + v AS DOUBLE))) AS BIGINT) AS u FROM tot, voc),
      w AS (SELECT cnt.lang, g, CAST(round(1000.0 * ln(CAST(c + 1 AS DOUBLE) / CAST(t + v AS DOUBLE))) AS BIGINT) - w0.u AS d
            FROM cnt JOIN tot USING (lang) JOIN w0 USING (lang), voc),
      src AS ({src}),
      q AS (SELECT {key} AS k, regexp_extract_all(lower({text}), '(?s).') AS cs FROM src
            WHERE regexp_matches({text}, '\\p{{L}}')),
      qg AS (SELECT k, {grams} AS g FROM q),
      qn AS (SELECT k, count(*) AS n FROM qg GROUP BY k),
      qs AS (SELECT qg.k, w.lang, sum(w.d) AS sd FROM qg JOIN w USING (g) GROUP BY qg.k, w.lang),
      sc AS (SELECT qn.k, w0.lang, qn.n * w0.u + coalesce(qs.sd, 0) AS score
             FROM qn CROSS JOIN w0 LEFT JOIN qs ON qs.k = qn.k AND qs.lang = w0.lang),
      best AS (SELECT k, max(score) AS m FROM sc GROUP BY k),
      pick AS (SELECT sc.k, CASE WHEN count(*) = 1 THEN min(sc.lang) END AS lang
               FROM sc JOIN best ON sc.k = best.k AND sc.score = best.m GROUP BY sc.k)"""


def backoff_ctes(src: str, distance: int) -> str:
    """Back-off n-grams of orders 1 to 5; a hit of order n stands for the unseen character and the steps it saves."""
    run = lambda n: f"list_transform(range(1, len(cs) - {n - 2}), lambda i: {{'p': i + {n - 1}, 'g': {' || '.join(f'cs[i + {k}]' for k in range(n))}}})"
    runs = f"unnest(list_concat({', '.join(run(n) for n in range(1, 6))}))"
    ln = lambda a, b: f"CAST(round(1000.0 * ln(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE))) AS BIGINT)"
    return f"""train AS (SELECT lang, regexp_extract_all(lower(text), '(?s).') AS cs FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL),
      long AS (SELECT lang, g, count(*) AS c FROM (SELECT lang, unnest(list_transform(range(1, len(cs) + 1), lambda i:
        cs[i] || coalesce(cs[i + 1], '') || coalesce(cs[i + 2], '') || coalesce(cs[i + 3], '') || coalesce(cs[i + 4], ''))) AS g FROM train) GROUP BY ALL),
      cnt AS (SELECT lang, left(g, n) AS g, sum(c)::BIGINT AS c FROM (SELECT *, unnest(range(1, length(g) + 1)) AS n FROM long) GROUP BY ALL),
      voc AS (SELECT count(DISTINCT g) AS v FROM cnt WHERE length(g) = 1),
      lang AS (SELECT lang, t, {ln('1', 't')} AS u FROM (SELECT lang, sum(c) + any_value(v) AS t FROM cnt, voc WHERE length(g) = 1 GROUP BY lang)),
      w AS (SELECT cnt.lang, cnt.g, {ln('c + 1', 't')} - u AS d FROM cnt JOIN lang USING (lang) WHERE length(g) = 1
        UNION ALL SELECT a.lang, a.g, {ln('a.c', 'b.c')} - u + 916 * (length(a.g) - 1) FROM cnt a JOIN cnt b
          ON a.lang = b.lang AND left(a.g, length(a.g) - 1) = b.g AND length(a.g) > 1 JOIN lang ON lang.lang = a.lang),
      src AS (SELECT row_number() OVER () AS id, text, regexp_extract_all(lower(text), '(?s).') AS cs FROM ({src}) WHERE regexp_matches(text, '\\p{{L}}')),
      hit AS (SELECT id, lang, p, max_by(d, length(q.g)) AS d FROM (SELECT id, x.p AS p, x.g AS g FROM (SELECT id, {runs} AS x FROM src)) q JOIN w ON q.g = w.g GROUP BY ALL),
      own AS (SELECT id, lang, count(*) AS known FROM (SELECT DISTINCT id, unnest(cs) AS g FROM src) JOIN w USING (g) WHERE regexp_matches(g, '\\p{{L}}') GROUP BY ALL),
      sc AS (SELECT src.id, lang.lang, len(cs) AS n, coalesce(known, 0) AS known, len(cs) * u + coalesce(s, 0) AS score FROM src, lang
        LEFT JOIN own ON own.id = src.id AND own.lang = lang.lang
        LEFT JOIN (SELECT id, lang, sum(d)::BIGINT AS s FROM hit GROUP BY ALL) h ON h.id = src.id AND h.lang = lang.lang),
      lead AS (SELECT *, row_number() OVER w AS k, lead(score) OVER w AS next FROM (SELECT * FROM sc QUALIFY known = max(known) OVER (PARTITION BY id))
        WINDOW w AS (PARTITION BY id ORDER BY score DESC)),
      pick AS (SELECT text, lang FROM lead JOIN src USING (id) WHERE k = 1 AND (next IS NULL OR (score > next AND score - next >= {distance} * n)))"""


def with_ctes(body: str, *names: str, extra: str = "") -> str:
    order: list[str] = []

    def add(n):
        for dep in DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    parts = [f"{n} AS ({CTES[n]})" for n in order]
    if extra:
        parts.append(extra)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


NAV = '<li><a href="([^"]*)">([^<]*)</a></li>'
META_LINKS = f"SELECT {slug('url')} || '.html' AS filename, url || '.pdf' AS url FROM pages WHERE page_id % 2 = 0"
STORE = "SELECT object_name, url, content_type, sha256(encode(props)) AS content_sha256 FROM store_plan"
PAGINATED = (f"SELECT url, page, {_q(SITE)} || split_part(url, '/search', 1) || '/search/' || CAST(page AS VARCHAR)"
             f" || split_part(url, '/search', 2) AS page_url FROM pubpages")


def insert_page(url: str, page: str) -> str:
    return (f"CASE WHEN len(string_split({url}, '/search')) = 2 THEN split_part({url}, '/search', 1) || '/search/' || "
            f"CAST({page} AS VARCHAR) || split_part({url}, '/search', 2) END")


ORACLE: dict[str, str] = {
    "scan_html_pages": "SELECT length(html || chr(10)) AS n_chars, md5(html || chr(10)) AS html_md5 FROM pages",
    "scan_json_batches": with_ctes("SELECT title, info_url, abstract, language FROM articles_lang", "articles_lang"),
    "scan_json_tolerant": "SELECT url || '.pdf' AS url FROM pages WHERE page_id % 2 = 0",
    "scan_html_every_file": with_ctes("SELECT file_name, length(html) AS n_chars, md5(html) AS html_md5 FROM html_files WHERE page_id % 7 <> 0", "html_files"),
    "scan_html_rejects": with_ctes("SELECT file_name, 'invalid UTF-8' AS error FROM html_files WHERE page_id % 7 = 0", "html_files"),
    "scan_json_items": with_ctes("SELECT file_name, pos::INTEGER AS pos, url FROM link_files WHERE kind IN (0, 5) OR (kind IN (1, 2) AND pos < 10)", "link_files"),
    "scan_json_item_errors": with_ctes(
        "SELECT DISTINCT file_name, CASE kind WHEN 3 THEN 'malformed JSON' WHEN 4 THEN 'not an array of objects' ELSE 'bad item' END AS error "
        "FROM link_files WHERE kind BETWEEN 1 AND 4", "link_files"),
    "scan_url_list": "SELECT url FROM pages UNION ALL SELECT '' AS url FROM pages WHERE page_id % 10 = 0",
    "scan_manifest": with_ctes("SELECT name FROM remote_objects WHERE starts_with(name, 'corpus/')", "remote_objects"),
    "sink_json_batches": with_ctes("SELECT info_url, language, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch FROM articles_lang", "articles_lang"),
    "sink_text_lines": "SELECT '/doc/' || CAST(doc_id AS VARCHAR) AS value FROM documents WHERE doc_id % 7 <> 0",
    "sink_json_single": with_ctes(f"SELECT info_url, language FROM articles_lang WHERE language IN {KEPT}", "articles_lang"),
    "sink_stored_objects": with_ctes(STORE, "store_plan"),
    "sink_object_store": with_ctes(f"""SELECT object_name, url, content_type, sha256(encode(props)) AS content_sha256 FROM (
        SELECT * FROM ({run_plan('id <= (SELECT max(event_id) // 2 FROM events)', 1)}) UNION ALL
        SELECT * FROM ({run_plan('id > (SELECT max(event_id) // 2 FROM events)', 2)}))
        QUALIFY row_number() OVER (PARTITION BY object_name ORDER BY run DESC) = 1""", "attempts"),
    "retry_outcome_runs": with_ctes(f"SELECT * FROM ({outcome_sql('SELECT * FROM attempts')})", "attempts"),
    "download_progress_steps": with_ctes(
        f"SELECT url, done, round(CAST(100 AS DOUBLE) * done / total, 2) AS percent FROM (SELECT url, state, count(*) OVER () AS total, "
        f"row_number() OVER (PARTITION BY state ORDER BY succeeded_at_us, success_id) AS done FROM ({outcome_sql(BY_BLOCK)})) "
        f"WHERE state = 'succeeded'", "attempts"),
    "unique_object_names": with_ctes(  # names with a suffix meet no other name in these tables
        r"SELECT url, CASE WHEN k = 1 THEN object_name ELSE regexp_replace(object_name, '(\.[^.]*)?$', '-' || k || '\1') END AS object_name "
        "FROM (SELECT *, row_number() OVER (PARTITION BY object_name ORDER BY url) AS k FROM (SELECT DISTINCT url, object_name FROM named_ok))", "named_ok"),
    "extract_records": f"""SELECT page_id, {san(unesc('t'))} AS text, {unesc('h')} AS href FROM (
        SELECT page_id, unnest(regexp_extract_all(html, {_q(NAV)}, 2)) AS t,
               unnest(regexp_extract_all(html, {_q(NAV)}, 1)) AS h FROM pages)""",
    "extract_records_sql": f"""SELECT page_id, {san(unesc('t'))} AS text, {unesc('h')} AS href FROM (
        SELECT page_id, unnest(regexp_extract_all(html, {_q(NAV)}, 2)) AS t,
               unnest(regexp_extract_all(html, {_q(NAV)}, 1)) AS h FROM pages)""",
    "extract_fields": with_ctes("SELECT title, info_url, abstract FROM cards", "cards"),
    "extract_meta_link": META_LINKS,
    "extract_facets": with_ctes("SELECT name, url, CASE WHEN article_count = 0 THEN NULL ELSE article_count END AS article_count FROM publishers", "publishers"),
    "extraction_misses": f"SELECT {slug('url')} || '.html' AS filename FROM pages WHERE page_id % 2 = 1",
    "extract_page_articles": with_ctes("SELECT page_id, title, url AS info_url, abstract FROM page_articles", "page_articles"),
    "page_count": with_ctes("SELECT url, article_count, CAST(ceil(article_count / 24) AS BIGINT) AS pages FROM publishers", "publishers"),
    "url_insert_page": with_ctes(
        f"SELECT url, {insert_page('url', 'CAST(ceil(article_count / 24) AS BIGINT)')} AS last_page_url, "
        f"{insert_page('name', '1')} AS name_as_url FROM publishers", "publishers"),
    "url_prefix": with_ctes(f"SELECT url, {_q(SITE)} || url AS abs_url FROM publishers", "publishers"),
    "path_basename": with_ctes("SELECT name, string_split(name, '/')[-1] AS base FROM remote_objects", "remote_objects"),
    "sanitize_text": f"SELECT doc_id, {san('text')} AS clean FROM documents",
    "parse_grouped_int": with_ctes(
        "SELECT url, CASE WHEN article_count = 0 THEN '' ELSE replace(format('{:,}', article_count), ',', '.') END AS count_text, "
        "CASE WHEN article_count = 0 THEN NULL ELSE article_count END AS value FROM publishers", "publishers"),
    "slugify": f"SELECT doc_id, {slug('text')} AS slug FROM documents",
    "slugify_unicode": f"SELECT doc_id, {uslug('text')} AS slug FROM documents",
    "content_type_ext": with_ctes(f"SELECT id, {ext('content_type')} AS ext FROM attempts", "attempts"),
    "object_name": with_ctes(f"SELECT id, {slug('url')} || {ext('content_type')} AS object_name FROM attempts", "attempts"),
    "language_label": f"SELECT doc_id, {label('lang')} AS from_code, {label(chr(39) + 'Language.' + chr(39) + ' || upper(' + label('lang') + ')')} AS from_enum FROM documents",
    "detect_language": with_ctes("SELECT k AS doc_id, lang AS language FROM src LEFT JOIN pick ON pick.k = src.doc_id",
                                 "articles_lang", extra=detect_ctes("SELECT doc_id, title FROM articles_lang", "doc_id", "title")),
    "detect_language_backoff": with_ctes("SELECT doc_id, lang AS language FROM articles_lang LEFT JOIN pick ON pick.text = articles_lang.title",
                                         "articles_lang", extra=backoff_ctes("SELECT DISTINCT title AS text FROM articles_lang", 300)),
    "project_records": with_ctes("SELECT title, info_url, abstract, CAST(NULL AS VARCHAR) AS language FROM cards", "cards"),
    "project_info_urls": with_ctes("SELECT info_url FROM articles_lang", "articles_lang"),
    "record_display": with_ctes("SELECT url, name || ' (' || coalesce(CAST(article_count AS VARCHAR), 'None') || ')' AS display FROM publishers", "publishers"),
    "filter_language": with_ctes(f"SELECT doc_id, title, language FROM articles_lang WHERE language IN {KEPT}", "articles_lang"),
    "filter_nonempty_url": META_LINKS,
    "filter_object_names": with_ctes("SELECT string_split(name, '/')[-1] AS name FROM remote_objects WHERE contains(name, '/') AND NOT ends_with(name, '/')", "remote_objects"),
    "filter_ok_status": with_ctes("SELECT id, url FROM attempts WHERE status = 200", "attempts"),
    "paginate_urls": with_ctes(PAGINATED, "pubpages"),
    "reconcile_uploaded": with_ctes("SELECT l.name, r.remote_copies FROM local_files l JOIN remote_names r USING (name)", "remote_names"),
    "reconcile_missing": with_ctes("SELECT r.name, r.remote_copies FROM remote_names r WHERE NOT EXISTS (SELECT 1 FROM local_files l WHERE l.name = r.name)", "remote_names"),
    "reconcile_remaining": with_ctes("SELECT l.name FROM local_files l WHERE NOT EXISTS (SELECT 1 FROM remote_names r WHERE r.name = l.name)", "remote_names"),
    "lookup_extension": with_ctes(f"SELECT id, {ext('content_type')} AS ext FROM attempts", "attempts"),
    "union_batches": with_ctes("SELECT doc_id, info_url, language FROM articles_lang", "articles_lang"),
    "language_counts": with_ctes("SELECT language, count(*) AS n, count(*) - 1 AS n_reference FROM articles_lang GROUP BY language", "articles_lang"),
    "download_progress": with_ctes(
        f"SELECT count(*) FILTER (WHERE state = 'succeeded') AS done, count(*) AS total, "
        f"round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE state = 'succeeded') / count(*), 2) AS percent "
        f"FROM ({outcome_sql('SELECT * FROM attempts')})", "attempts"),
    "batch_row_counts": "SELECT batch, sum(n)::BIGINT AS n FROM (SELECT n, (sum(n) OVER (ORDER BY page) - n)::BIGINT // 25 AS batch "
                        "FROM (SELECT doc_id // 10 AS page, count(*) AS n FROM documents GROUP BY 1)) GROUP BY batch",
    "retry_outcome": with_ctes(f"SELECT * FROM ({outcome_sql('SELECT * FROM attempts')})", "attempts"),
    "retry_schedule": with_ctes(
        f"SELECT url, attempts_used AS retry_no, round(CAST(0.5 AS DOUBLE) * (attempts_used - 1), 3) AS delay_s "
        f"FROM ({outcome_sql(BY_BLOCK)}) WHERE state = 'pending'", "attempts"),
    "latest_object": with_ctes("SELECT object_name, id, url FROM named_ok QUALIFY row_number() OVER (PARTITION BY object_name ORDER BY fetched_at DESC, id DESC) = 1", "named_ok"),
    "object_name_collisions": with_ctes("SELECT object_name, count(DISTINCT url) AS n_urls, min(url) AS first_url, max(url) AS last_url FROM named_ok GROUP BY object_name HAVING count(DISTINCT url) > 1", "named_ok"),
    "job_publishers": with_ctes("SELECT name, url, CASE WHEN article_count = 0 THEN NULL ELSE article_count END AS article_count FROM publishers", "publishers"),
    "job_listing_urls": with_ctes(f"SELECT page_url AS url FROM ({PAGINATED})", "pubpages"),
    "job_articles": with_ctes("SELECT title, info_url, abstract FROM cards", "cards"),
    "job_articles_rejects": "SELECT DISTINCT doc_id // 10 || '.html' AS file_name, 'invalid UTF-8' AS error FROM documents WHERE (doc_id // 10) % 7 = 0",
    "job_publishers_from_files": with_ctes(
        "SELECT name, url, CASE WHEN article_count = 0 THEN NULL ELSE article_count END AS article_count "
        "FROM (SELECT *, min(s_suppkey) OVER (PARTITION BY s_nationkey, s_suppkey // 50) AS page FROM publishers) WHERE page % 7 <> 0", "publishers"),
    "job_publishers_rejects": "SELECT page_id, 'UnicodeDecodeError' AS error FROM (SELECT min(s_suppkey) AS page_id FROM supplier "
                              "GROUP BY s_nationkey, s_suppkey // 50) WHERE page_id % 7 = 0",
    "job_listing_urls_rejects": "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN s_suppkey % 17 = 0 THEN 'malformed JSON' WHEN s_suppkey % 3 = 0 "
                                "THEN 'missing field' WHEN s_suppkey % 5 = 0 THEN 'no single search part in the URL' END AS reason FROM supplier) "
                                "WHERE reason IS NOT NULL GROUP BY reason",
    "job_info_urls_rejects": """SELECT '{"title": "' || doc_id AS record FROM documents WHERE doc_id % 17 = 0""",
    "job_language_rejects": """SELECT '{"title": "' || doc_id AS record FROM documents WHERE doc_id % 17 = 0""",
    "job_articles_stream": with_ctes("SELECT title, info_url, abstract FROM cards", "cards"),
    "job_language": with_ctes(f"SELECT src.info_url, {label('pick.lang')} AS language FROM src LEFT JOIN pick ON pick.k = src.doc_id",
                              "articles_lang", extra=detect_ctes("SELECT doc_id, info_url, title FROM articles_lang", "doc_id", "title")),
    "job_language_filter": with_ctes(f"SELECT info_url, language FROM articles_lang WHERE language IN {KEPT}", "articles_lang"),
    "job_info_urls": "SELECT '/doc/' || CAST(doc_id AS VARCHAR) AS value FROM documents WHERE doc_id % 7 <> 0",
    "job_download_links": META_LINKS,
    "job_download_links_from_files": f"SELECT {slug('url')} || '.html' AS filename, url || '.pdf' AS url FROM pages WHERE page_id % 2 = 0 AND page_id % 7 <> 0",
    "job_download_links_from_files_misses": f"SELECT {slug('url')} || '.html' AS filename FROM pages WHERE page_id % 2 = 1 OR page_id % 7 = 0",
    "job_download_urls_errors": with_ctes(
        "SELECT 'url' AS kind, url AS value FROM link_files WHERE kind IN (0, 5) OR (kind IN (1, 2) AND pos < 10) UNION ALL "
        "SELECT DISTINCT CASE kind WHEN 3 THEN 'malformed JSON' WHEN 4 THEN 'not an array of objects' ELSE 'bad item' END, file_name "
        "FROM link_files WHERE kind BETWEEN 1 AND 4", "link_files"),
    "job_download_urls": "SELECT url || '.pdf' AS value FROM pages WHERE page_id % 2 = 0",
    "job_store_objects": with_ctes(STORE, "store_plan"),
    "job_reconcile": with_ctes("SELECT l.name, r.remote_copies FROM local_files l JOIN remote_names r USING (name)", "remote_names"),
    "job_language_filter_arrays": with_ctes("SELECT language, count(*) AS n, count(*) - 1 AS n_reference FROM articles_lang GROUP BY language", "articles_lang"),
    "job_info_urls_arrays": "SELECT '/doc/' || CAST(doc_id AS VARCHAR) AS value FROM documents",
    "scan_json_arrays": with_ctes("SELECT title, info_url, abstract, language FROM articles_lang", "articles_lang"),
    "job_download_links_misses": f"SELECT {slug('url')} || '.html' AS filename FROM pages WHERE page_id % 2 = 1",
    "job_store_progress": with_ctes(
        f"SELECT count(*) FILTER (WHERE state = 'succeeded') AS done, count(*) AS total, "
        f"round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE state = 'succeeded') / count(*), 2) AS percent "
        f"FROM ({outcome_sql('SELECT * FROM attempts')})", "attempts"),
    "job_reconcile_not_found": with_ctes("SELECT r.name, r.remote_copies FROM remote_names r WHERE NOT EXISTS (SELECT 1 FROM local_files l WHERE l.name = r.name)", "remote_names"),
    "job_reconcile_remaining": with_ctes("SELECT l.name FROM local_files l WHERE NOT EXISTS (SELECT 1 FROM remote_names r WHERE r.name = l.name)", "remote_names"),
    "page_language_counts": with_ctes(
        f"SELECT language, count(*) AS n, count(*) - 1 AS n_reference FROM (SELECT {label('pick.lang')} AS language "
        f"FROM src LEFT JOIN pick ON pick.k = src.page_id) GROUP BY language",
        "page_articles", extra=detect_ctes("SELECT page_id, title FROM page_articles", "page_id", "title")),
}
