"""Column functions: each takes Columns (or names) and returns a Column evaluated JVM-side."""

from pagesmith.functions.urls import page_count, url_insert_page, url_prefix, path_basename
from pagesmith.functions.text import sanitize_text, parse_grouped_int, language_label, record_display, WHITESPACE_CLASS
from pagesmith.functions.slug import slugify, slugify_unicode
from pagesmith.functions.content import content_type_ext, object_name

__all__ = [
    "page_count", "url_insert_page", "url_prefix", "path_basename",
    "sanitize_text", "parse_grouped_int", "language_label", "record_display", "WHITESPACE_CLASS",
    "slugify", "slugify_unicode", "content_type_ext", "object_name",
]
