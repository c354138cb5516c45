"""URL allow and block rules, with decisions carried over to aliases of a URL.

A rule ``host/path`` fits its host and all subdomains when the URL's path starts with the rule's; the
longest rule wins.  Every URL is expanded to its host suffixes and to the path prefixes whose lengths
occur among the rules, so that rules of any number are found by one equality join.

URLs that redirect to each other, or name another as canonical, are one resource: connected
components over those edges carry a decision to members that no rule fits.  An explicit allow
anywhere in the component takes precedence over a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _node(url: Column) -> Column:
    """What names a resource among aliases: host, path and query, without scheme and fragment."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.concat(host(url), path(url), query)


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)\b{name}{VALUE}"
    return F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))


def _absolute(href: Column, url: Column) -> Column:
    """A link as a whole URL, resolved against the page's."""
    href = F.replace(F.btrim(href), F.lit("&amp;"), F.lit("&"))
    folder = F.regexp_replace(path(url), r"[^/]*$", "")
    base = F.concat(F.lit("http://"), host(url))
    return (F.when(href == "", None).when(href.contains("://"), href)
            .when(href.startswith("//"), F.concat(F.lit("http:"), href))
            .when(href.startswith("/"), F.concat(base, href))
            .when(host(url) != "", F.concat(base, F.when(folder == "", "/").otherwise(folder), href)))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) of the canonical links and immediate redirects that pages state in their head.
    Pages without either, with a null URL or null html give no row."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    link = F.regexp_extract(html, r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    meta = F.regexp_extract(html, r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    target = F.regexp_extract(_attribute(meta, "content"), r"(?is)\burl\s*=\s*['\"]?([^'\"]*)", 1)
    url = F.col(url_col)
    two = F.array(_absolute(_attribute(link, "href"), url), _absolute(target, url))
    named = html.rlike(r"(?i)canonical|refresh")
    return (pages.where(named & url.contains("://")).select(url.alias("src"), F.explode(two).alias("dst"))
            .where("dst is not null"))


def _suffixes(h: Column, most: int) -> Column:
    """The host and the domains above it, of up to ``most`` labels: a.b.c -> a.b.c, b.c, c."""
    labels = F.split(h, r"\.")
    n = F.size(labels)
    first = F.greatest(F.lit(1), n - (most - 1))
    return F.transform(F.sequence(first, n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def fit_rules(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, allow) for those distinct (host, path) of ``sites`` that a rule fits.
    ``rules``: (rule string such as ``example.com/en/``, allow boolean)."""
    parts = rules.select("rule", "allow", F.substring_index("rule", "/", 1).alias("rule_host"),
                         F.expr("substr(rule, instr(rule, '/'))").alias("rule_path")).where("instr(rule, '/') > 1")
    known = parts.agg(F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
                      F.max(F.size(F.split("rule_host", r"\."))).alias("labels")).first()
    lengths = known["lengths"] or [0]
    tries = (sites.select("host", "path").distinct()
             .select("host", "path", F.explode(_suffixes(F.col("host"), known["labels"] or 1)).alias("rule_host"),
                     F.array(*(F.lit(n) for n in lengths)).alias("ns"))
             .select("host", "path", "rule_host", F.explode("ns").alias("n")).where("n <= length(path)")
             .select("host", "path", "rule_host", F.expr("substr(path, 1, n)").alias("rule_path")))
    best = F.max_by(F.struct("rule", "allow"), F.struct(F.length("rule"), F.length("rule_host"), "allow", "rule"))
    return (tries.join(parts, ["rule_host", "rule_path"]).groupBy("host", "path").agg(best.alias("r"))
            .select("host", "path", "r.rule", "r.allow"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: (id, host, path, rule, verdict).

    * ``rule``: the longest rule that fits, else null; ``verdict``: that rule's.
    * Without a rule: allow if a member of its alias component is explicitly allowed, else block if
      one is blocked, else allow.
    * ``redirects``: further (src, dst) URL pairs, such as a crawler's redirect log.
    * A null URL or one without ``://`` has empty host and path and no alias.  Null ids, repeated
      rows and extra columns of ``pages`` are allowed; html is read for links only.
    """
    url = F.col(url_col)
    p = pages.select(F.col(id_col).alias("id"), url.alias("url")).select(
        "id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), _node(F.col("url")).alias("node"))
    edges = page_links(pages, url_col, html_col) if html_col else None
    if redirects is not None:
        more = redirects.select("src", "dst")
        edges = more if edges is None else edges.unionByName(more)
    if edges is None:
        edges = pages.sparkSession.createDataFrame([], "src string, dst string")
    edges = edges.where("src like '%://%' and dst like '%://%'")
    comps = connected_components(edges.select(_node(F.col("src")).alias("a"), _node(F.col("dst")).alias("b")))

    ends = edges.select(F.explode(F.array("src", "dst")).alias("u")).select(
        host(F.col("u")).alias("host"), path(F.col("u")).alias("path"), _node(F.col("u")).alias("node"))
    fits = fit_rules(p.select("host", "path").unionByName(ends.select("host", "path")), rules)
    members = ends.distinct().join(comps, "node").join(fits, ["host", "path"])
    carried = members.groupBy("component").agg(F.max("allow").alias("alias_allow"))
    aliases = comps.join(carried, "component").select("node", "alias_allow")
    return (p.join(fits, ["host", "path"], "left").join(aliases, "node", "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.when(F.coalesce("allow", "alias_allow", F.lit(True)), "allow").otherwise("block").alias("verdict")))
