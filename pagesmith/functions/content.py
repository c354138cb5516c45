"""Content type -> file extension, and stored object names."""

from __future__ import annotations

import functools
import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesmith.functions._col import col
from pagesmith.functions.slug import slugify

# The fetch step's own content-type table (exact, case-sensitive keys).
EXTENSION_MAP = {
    "application/pdf": ".pdf",
    "application/epub+zip": ".epub",
    "image/jpeg": ".jpg",
    "image/png": ".png",
    "text/html": ".html",
    "text/html; charset=UTF-8": ".html",
    "application/json": ".json",
    "image/tiff": ".tiff",
    "application/x-mobipocket-ebook": ".mobi",
    "image/vnd.djvu": ".djvu",
}
DEFAULT_EXT = ".txt"


@functools.lru_cache(maxsize=1)
def mime_table() -> dict[str, str]:
    """Snapshot of the standard library's built-in MIME table (host files ignored), as
    lower-case type -> first extension, the answer of ``guess_extension``."""
    db = mimetypes.MimeTypes(filenames=())
    return {t: db.guess_extension(t) for t in sorted(db.types_map_inv[True]) if db.guess_extension(t)}


def _map_lit(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(d.items()) for x in kv])


def content_type_ext(c: Column | str, extension_map: dict[str, str] | None = None,
                     normalize: bool = False) -> Column:
    """Extension for a Content-Type: exact match in the fetch step's table, else the MIME table
    (case-insensitive), else '.txt'.  NULL type -> NULL.  ``normalize=True`` drops parameters
    ('; charset=...') and lower-cases before both lookups."""
    c = col(c)
    key = F.lower(F.trim(F.substring_index(c, ";", 1))) if normalize else c
    emap = extension_map if extension_map is not None else EXTENSION_MAP
    if normalize:
        emap = {k.split(";")[0].strip().lower(): v for k, v in emap.items()}
    ext = F.coalesce(F.try_element_at(_map_lit(emap), key),
                     F.try_element_at(_map_lit(mime_table()), F.lower(key)),
                     F.lit(DEFAULT_EXT))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(ext)


def object_name(url: Column | str, content_type: Column | str, **kw) -> Column:
    """Stored object name of a fetched URL: slug(url) + extension(content type)."""
    return F.concat(slugify(url), content_type_ext(content_type, **kw))
