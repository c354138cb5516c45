"""URL building for paginated listings (page count, page insertion, prefixing, base names)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesmith.functions._col import col

# Fixed values of the listing portal: results per listing page and the path part a page number follows.
PAGE_SIZE = 24
SEARCH_SEGMENT = "/search"


def page_count(n: Column | str, page_size: int = PAGE_SIZE) -> Column:
    """ceil(n / page_size) as bigint; NULL stays NULL, 0 gives 0."""
    return F.ceil(col(n).cast("double") / F.lit(float(page_size))).cast("bigint")


def _regex_literal(s: str) -> str:
    return "\\Q" + s + "\\E"


def url_insert_page(url: Column | str, page: Column | str, sep: str = SEARCH_SEGMENT,
                    failfast: bool = False) -> Column:
    """Put ``sep + '/' + page`` in place of the only occurrence of ``sep``.

    A URL with no or several occurrences is invalid: NULL here (route it to a reject table), or an
    error at run time with ``failfast=True``.
    """
    parts = F.split(col(url), _regex_literal(sep), -1)
    built = F.concat(parts.getItem(0), F.lit(sep + "/"), col(page).cast("string"), parts.getItem(1))
    ok = F.size(parts) == 2
    bad = F.raise_error(F.concat(F.lit("not exactly one search segment in URL "), F.coalesce(col(url), F.lit("NULL")))) \
        if failfast else F.lit(None).cast("string")
    return F.when(ok, built).otherwise(bad)


def url_prefix(url: Column | str, prefix: str) -> Column:
    """Plain concatenation of a site prefix and a relative URL (no URL joining)."""
    return F.concat(F.lit(prefix), col(url))


def path_basename(path: Column | str) -> Column:
    """Last '/'-separated part of a path or object name."""
    return F.substring_index(col(path), "/", -1)
