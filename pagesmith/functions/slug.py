"""URL/file-name slugs.

``slugify`` is the ASCII rule (NFKD, drop non-ASCII, lower, keep word chars, space and '-', collapse
runs of space/'-' into one '-', strip '-' and '_').  Spark SQL has no NFKD function, but NFKD followed
by dropping non-ASCII works code point by code point, so the rule is compiled at plan time from the
Unicode tables into a ``translate`` table (one-letter results) and a small map (multi-letter results)
and evaluated natively.  Pure-ASCII strings skip both lookups.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesmith.functions._col import col
from pagesmith.functions.text import WHITESPACE_CLASS

# Python's ASCII whitespace for \s in str patterns (includes the \x1c-\x1f separators).
_ASCII_SPACE = " \\t\\n\\r\\x0b\\x0c\\x1c-\\x1f"


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[str, str, dict[str, str]]:
    """(translate source, translate target, multi-letter map) for non-ASCII code points whose NFKD
    form keeps ASCII letters; every other non-ASCII code point is deleted afterwards."""
    src, dst, multi = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(out) == 1:
            src.append(ch)
            dst.append(out)
        elif len(out) > 1:
            multi[ch] = out
    return "".join(src), "".join(dst), multi


def to_ascii(c: Column | str) -> Column:
    """NFKD + drop non-ASCII, natively."""
    src, dst, multi = _tables()
    c = col(c)
    several = "".join(sorted(multi))
    m = F.create_map(*[F.lit(x) for kv in sorted(multi.items()) for x in kv])
    # a char-set translate is a hash lookup per character; the map, a linear one, is asked once per distinct letter
    letters = F.array_distinct(F.split(F.regexp_replace(c, "[\\x00-\\x7f]+", ""), ""))
    present = F.filter(letters, lambda ch: (ch != "") & (F.translate(ch, several, "") == ""))
    expanded = F.aggregate(present, c, lambda text, ch: F.replace(text, ch, F.element_at(m, ch)))
    has_multi = F.length(F.translate(c, several, "")) != F.length(c)
    step1 = F.when(has_multi, expanded).otherwise(c)
    step2 = F.regexp_replace(F.translate(step1, src, dst), "[^\\x00-\\x7f]", "")
    return F.when(c.rlike("[^\\x00-\\x7f]"), step2).otherwise(c)


def _slug_tail(ascii_text: Column) -> Column:
    kept = F.regexp_replace(F.lower(ascii_text), f"[^A-Za-z0-9_{_ASCII_SPACE}-]", "")
    dashed = F.regexp_replace(kept, f"[{_ASCII_SPACE}-]+", "-")
    return F.regexp_replace(dashed, "\\A[-_]+|[-_]+\\z", "")


def slugify(c: Column | str) -> Column:
    """ASCII slug of a text column (see module doc); NULL -> 'none' as Python's str(None) would give."""
    c = F.coalesce(col(c).cast("string"), F.lit("None"))
    return _slug_tail(to_ascii(c))


def slugify_unicode(c: Column | str) -> Column:
    """Unicode slug: compatibility normal form, lower case, letters, numbers, '_', white space and '-' kept,
    runs of the last two become one '-', none at either end.  Only the normal form, which Spark SQL lacks,
    is a (vectorised) UDF; the rules are native."""
    @F.pandas_udf(T.StringType())
    def normal_form(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    ws = WHITESPACE_CLASS[1:-1]
    text = F.lower(normal_form(F.coalesce(col(c).cast("string"), F.lit("None"))))
    kept = F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}_{ws}-]+", "")
    return F.regexp_replace(F.regexp_replace(kept, f"[{ws}-]+", "-"), "\\A[-_]+|[-_]+\\z", "")
