"""Text clean-up columns: sanitize, grouped integers, language labels, display strings."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesmith.functions._col import col


def _char_class(pred) -> str:
    """A regex character class (``\\x{..}`` escapes, valid in Java and RE2) of all code points
    satisfying ``pred``, compressed into ranges."""
    cps = [cp for cp in range(sys.maxunicode + 1) if not 0xD800 <= cp <= 0xDFFF and pred(chr(cp))]
    parts, start, prev = [], None, None
    for cp in cps + [None]:
        if start is not None and cp == prev + 1:
            prev = cp
            continue
        if start is not None:
            parts.append(f"\\x{{{start:x}}}" if start == prev else f"\\x{{{start:x}}}-\\x{{{prev:x}}}")
        start = prev = cp
    return "[" + "".join(parts) + "]"


# Every code point Python's str.strip() removes (str.isspace), derived from the Unicode tables.
WHITESPACE_CHARS = "".join(chr(cp) for cp in range(sys.maxunicode + 1)
                           if not 0xD800 <= cp <= 0xDFFF and chr(cp).isspace())
WHITESPACE_CLASS = _char_class(str.isspace)
STRIP_PATTERN = f"\\A{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+\\z"


def strip_text(c: Column | str) -> Column:
    """Remove leading/trailing whitespace in the Unicode sense (NBSP, U+2000.., U+3000, \\x1c-\\x1f).
    A character-set trim: it only looks at the ends, whatever the length of the text."""
    return F.btrim(col(c), F.lit(WHITESPACE_CHARS))


def sanitize_text(c: Column | str) -> Column:
    """Strip both ends, then turn every newline and every tab into one space; runs are kept."""
    return F.translate(strip_text(c), "\n\t", "  ")


def parse_grouped_int(c: Column | str, group_sep: str = ".", failfast: bool = False) -> Column:
    """'3.159' -> 3159.  Empty or non-numeric text gives NULL (or a cast error with ``failfast``)."""
    cleaned = F.replace(strip_text(c), F.lit(group_sep), F.lit(""))
    cleaned = F.when(cleaned == "", F.lit(None)).otherwise(cleaned)
    return cleaned.cast("int") if failfast else cleaned.try_cast("int")


# ISO 639-1 codes of the corpus languages and their lower-case English names.
ISO_LANGUAGE_NAMES = {
    "en": "english",
    "tr": "turkish",
    "az": "azerbaijani",
    "fr": "french",
    "de": "german",
    "es": "spanish",
}


def language_label(c: Column | str) -> Column:
    """'Language.TURKISH' -> 'turkish'; ISO code 'tr' -> 'turkish'; other text lower-cased; NULL -> NULL."""
    c = col(c)
    enum_part = F.lower(F.try_element_at(F.split(c, "\\."), F.lit(2)))
    iso = F.create_map(*[F.lit(x) for kv in ISO_LANGUAGE_NAMES.items() for x in kv])
    by_code = F.coalesce(F.try_element_at(iso, F.lower(c)), F.lower(c))
    return F.when(c.isNull(), F.lit(None).cast("string")) \
        .when(c.contains("."), enum_part) \
        .otherwise(by_code)


def record_display(left: Column | str, right: Column | str) -> Column:
    """'left (right)' as Python formats it: NULL shows as 'None'."""
    def s(x):
        return F.coalesce(col(x).cast("string"), F.lit("None"))
    return F.concat(s(left), F.lit(" ("), s(right), F.lit(")"))
