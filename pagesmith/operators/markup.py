"""Record and field extraction from HTML pages (X1-X5), one-to-many, in Arrow batches.

A *record* is every element matching ``record`` (searched recursively, nested matches included),
optionally inside the first match of ``scope``.  A *field* follows a path of steps from the record
(first match at each step) and takes the element's text or an attribute (``@name``).  Missing
elements give NULL; a missing attribute on a found element is NULL in PERMISSIVE mode and an error
in FAILFAST mode.  Pages the parser cannot handle go to the ``_error`` column instead of failing the
job.  Only the key columns and the HTML column cross into Python; text clean-up runs natively after.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeResult

from pagesmith.functions.text import parse_grouped_int, sanitize_text

PERMISSIVE, FAILFAST = "PERMISSIVE", "FAILFAST"
PARSE_PARTITIONS = "pagesmith.parse.partitions"


@dataclass(frozen=True)
class Field:
    name: str
    path: tuple[str, ...]      # selector steps, e.g. ('h5[class=card-title]', 'a')
    take: str = "text"         # 'text' or '@attribute'


# Selector presets of the listing portal's markup (tags, class strings, meta name).
ARTICLE_CARD = 'div[class="card article-card dp-card-outline"]'
ARTICLE_FIELDS = (
    Field("title", ('h5[class="card-title"]', "a"), "text"),
    Field("info_url", ('h5[class="card-title"]', "a"), "@href"),
    Field("abstract", ('div[class="card-text article-text-block"]',), "text"),
)
FACET_SCOPE = 'div[class="kt-widget-18"]'
FACET_ITEM = 'div[class="kt-widget-18__item kt-hidden more-item"]'
FACET_FIELDS = (
    Field("name", ("a",), "text"),
    Field("url", ("a",), "@href"),
    Field("count_text", ('div[class="kt-widget-18__orders"]',), "text"),
)
PDF_META = 'meta[name="citation_pdf_url"]'


def _extractor(key_names, html_name, scope, record, fields, mode, whole_page):
    from pagesmith.operators import htmltree as H

    scope_c = [H.compile_step(s) for s in scope] if scope else None
    record_c = H.compile_step(record) if record else None
    field_c = [(f.name, [H.compile_step(s) for s in f.path], f.take) for f in fields]
    cols = None if html_name is None else list(key_names) + ["record_no"] + [f.name for f in fields] + ["_error"]

    # whole-page records whose fields are all attributes of a one-step path need no tree: the
    # first matching start tag answers them, and parsing stops there (e.g. a <meta> in <head>)
    tag_only = whole_page and not scope_c and all(len(p) == 1 and t != "text" for _, p, t in field_c)

    def one_tag_page(html):
        vals = []
        for name, path, take in field_c:
            attrs = H.first_tag_attrs(html, path[0])
            v = None if attrs is None else attrs.get(take[1:].lower())
            if attrs is not None and v is None and mode == FAILFAST:
                raise KeyError(f"{take} missing for field {name}")
            vals.append(v)
        return [[0] + vals]

    def one_page(html):
        if tag_only:
            return one_tag_page(html)
        root = H.parse(html)
        base = H.follow(root, scope_c) if scope_c else root
        if base is None:
            return []
        recs = [base] if whole_page else H.find_all(base, record_c)
        out = []
        for i, rec in enumerate(recs):
            vals = []
            for name, path, take in field_c:
                node = H.follow(rec, path)
                if node is None:
                    vals.append(None)
                elif take == "text":
                    vals.append(node.text())
                else:
                    v = node.attrs.get(take[1:].lower())
                    if v is None and mode == FAILFAST:
                        raise KeyError(f"{take} missing on <{node.tag}> for field {name}")
                    vals.append(v)
            out.append([i] + vals)
        return out

    if cols is None:  # one page at a time
        return one_page

    def run(batches):
        for batch in batches:
            names, n_keys = batch.schema.names, len(key_names)
            at, numbers, errors = [], [], []
            values: list[list] = [[] for _ in field_c]
            # as bytes: decoding is part of reading a page, and a page that isn't valid UTF-8 is one the parser can't handle
            for row, html in enumerate(batch.column(names.index(html_name)).cast(pa.large_binary())):
                html = html.as_py()
                if html is None:
                    continue
                try:
                    found = one_page(html.decode())
                except Exception as e:  # one bad page must not end the job
                    if mode == FAILFAST:
                        raise
                    found = [[None] * (1 + len(field_c))]
                    errors += [None] * (len(at) - len(errors)) + [f"{type(e).__name__}: {e}"]
                for rec in found:
                    at.append(row)
                    numbers.append(rec[0])
                    for column, value in zip(values, rec[1:]):
                        column.append(value)
            errors += [None] * (len(at) - len(errors))
            rows = pa.array(at, pa.int64())
            # keys stay Arrow values: nulls and large integers come out as they went in
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(rows) for k in range(n_keys)] + [pa.array(numbers, pa.int32())]
                + [pa.array(v, pa.string()) for v in values] + [pa.array(errors, pa.string())], names=cols)

    return run


def extract_records(pages: DataFrame, fields, record: str | None = None, keys=("page_id",),
                    html_col: str = "html", scope=None, mode: str = PERMISSIVE,
                    with_errors: bool = False, partitions: int | None = None) -> DataFrame:
    """X1 + X2: one output row per matching record of each page: keys, record_no, raw field values.

    ``record=None`` treats the whole page (or scope) as the single record.  ``with_errors`` adds the column
    ``_error`` and a row for every page the parser couldn't handle.  ``partitions`` (or the session's
    ``pagesmith.parse.partitions``) deals the pages out first, for inputs of a few unsplittable files; unset, the
    scan's partitions are kept.  Building the plan runs nothing.
    """
    partitions = partitions or int(pages.sparkSession.conf.get(PARSE_PARTITIONS, "0"))
    keys = list(keys)
    src = pages.select(*keys, html_col)
    out_fields = [T.StructField(k, src.schema[k].dataType) for k in keys]
    out_fields.append(T.StructField("record_no", T.IntegerType()))
    out_fields += [T.StructField(f.name, T.StringType()) for f in fields]
    out_fields.append(T.StructField("_error", T.StringType()))
    fn = _extractor(keys, html_col, scope, record, fields, mode, record is None)
    out = (src.repartition(partitions) if partitions else src).mapInArrow(fn, T.StructType(out_fields))
    return out if with_errors else out.filter(F.col("_error").isNull()).drop("_error")


def extraction_errors(pages: DataFrame, fields, record=None, keys=("page_id",), html_col="html",
                      scope=None) -> DataFrame:
    """Reject table of pages the parser could not handle: keys + error text."""
    out = extract_records(pages, fields, record, keys, html_col, scope, PERMISSIVE, with_errors=True)
    return out.filter(F.col("_error").isNotNull()).select(*keys, "_error")


def extract_articles(pages: DataFrame, keys=("page_id",), html_col="html", mode=PERMISSIVE) -> DataFrame:
    """Listing pages -> article cards (title, info_url, abstract); all-NULL cards are kept."""
    return clean_articles(extract_records(pages, ARTICLE_FIELDS, ARTICLE_CARD, keys, html_col, mode=mode), keys)


def clean_articles(recs: DataFrame, keys=()) -> DataFrame:
    """Raw values of article cards -> clean text."""
    return recs.select(*keys, "record_no", sanitize_text("title").alias("title"), "info_url",
                       sanitize_text("abstract").alias("abstract"))


def extract_facets(pages: DataFrame, keys=("page_id",), html_col="html", scope=FACET_SCOPE,
                   item=FACET_ITEM, fields=FACET_FIELDS, mode=PERMISSIVE) -> DataFrame:
    """Facet block -> publishers (name, url, article_count).  Only items carrying the full
    hidden-"more" class string are taken; default-visible items are left out."""
    recs = facet_records(pages, keys, html_col, scope, item, fields, mode)
    return clean_facets(recs.where("_error is null"), keys, mode)


def facet_records(pages: DataFrame, keys=("page_id",), html_col="html", scope=FACET_SCOPE, item=FACET_ITEM, fields=FACET_FIELDS,
                  mode=PERMISSIVE) -> DataFrame:
    """Raw values of facet items, with ``_error`` rows for pages the parser couldn't handle."""
    return extract_records(pages, fields, item, keys, html_col, scope=(scope,), mode=mode, with_errors=True)


def clean_facets(recs: DataFrame, keys=(), mode=PERMISSIVE) -> DataFrame:
    return recs.select(*keys, "record_no", sanitize_text("name").alias("name"), "url",
                       parse_grouped_int("count_text", failfast=(mode == FAILFAST)).alias("article_count"))


def meta_links(pages: DataFrame, name_col: str = "filename", html_col: str = "html", meta: str = PDF_META,
               prefilter: bool = True, mode: str = PERMISSIVE) -> tuple[DataFrame, DataFrame]:
    """(parsed, skipped): one row (filename, url, _error) per candidate page, url NULL or '' when the meta or
    its content is missing or the page couldn't be parsed; and the pages the native pre-filter skipped."""
    needle = meta.split("=", 1)[1].strip('"]\'')
    src = pages.select(F.col(name_col).alias("filename"), html_col)
    has = F.coalesce(F.col(html_col).contains(needle), F.lit(False)) if prefilter else F.col(html_col).isNotNull()
    field = (Field("url", (meta,), "@content"),)
    parsed = extract_records(src.filter(has), field, None, ["filename"], html_col, mode=mode, with_errors=True)
    return parsed.select("filename", "url", "_error"), src.filter(~has).select("filename")


def _usable(c: str = "url") -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def extract_meta_link(pages: DataFrame, name_col: str = "filename", html_col: str = "html",
                      meta: str = PDF_META, prefilter: bool = True, mode=PERMISSIVE) -> DataFrame:
    """(filename, url) from the first matching <meta>'s content; pages without one, or with an
    empty content, are dropped.  ``prefilter`` skips pages that cannot contain the meta name before
    any Python runs (turn off if the name may be written with character references)."""
    parsed, _ = meta_links(pages, name_col, html_col, meta, prefilter, mode)
    return parsed.filter(_usable()).select("filename", "url")


def extraction_misses(pages: DataFrame, name_col: str = "filename", html_col: str = "html",
                      meta: str = PDF_META, prefilter: bool = True) -> DataFrame:
    """The inputs that ``extract_meta_link`` gives no row for: no meta, no or empty content, or a page the
    parser rejects.  No join is needed: every page is parsed to one row or skipped by the pre-filter."""
    parsed, skipped = meta_links(pages, name_col, html_col, meta, prefilter, PERMISSIVE)
    return parsed.filter(~_usable()).select("filename").unionByName(skipped)


def parse_field(text: str) -> Field:
    """``name=step > step > @attribute``; without ``@attribute`` the element's text."""
    name, _, path = text.partition("=")
    steps = [x.strip() for x in path.split(" > ")]
    take = steps.pop() if steps[-1].startswith("@") else "text"
    if not name.strip() or not all(steps):
        raise ValueError(f"a field is name=step > ... > @attribute, not {text!r}")
    return Field(name.strip(), tuple(steps), take)


@dataclass
class _RecordPlan(AnalyzeResult):
    record: str | None = None
    fields: tuple = ()


class ExtractRecords:
    """X1 and X2 as a table function: ``extract_records(html, record, field, ...)`` gives (record_no, one string per field) for
    every element that matches ``record`` (the whole page if it is null).  Record and fields are constants; they set the
    output columns.  A null page has no record, and neither has one the parser can't handle."""

    def __init__(self, plan: _RecordPlan):
        self.records = _extractor((), None, None, plan.record, plan.fields, PERMISSIVE, plan.record is None)

    @staticmethod
    def analyze(html, record, *fields) -> _RecordPlan:
        if not (record.isConstantExpression and fields and all(f.isConstantExpression and f.value for f in fields)):
            raise ValueError("extract_records takes the page, a constant record selector and constant fields")
        parsed = tuple(parse_field(f.value) for f in fields)
        schema = T.StructType([T.StructField("record_no", T.IntegerType()), *(T.StructField(f.name, T.StringType()) for f in parsed)])
        return _RecordPlan(schema, record=record.value, fields=parsed)

    def eval(self, html, record, *fields):
        try:
            found = self.records(html) if html is not None else []
        except Exception:  # one bad page must not end the query
            found = []
        for values in found:
            yield tuple(values)


def register_sql(spark) -> None:
    """Makes ``extract_records`` callable from SQL: ``FROM pages p, LATERAL extract_records(p.html, 'li', 'href=a > @href')``."""
    spark.udtf.register("extract_records", F.udtf(ExtractRecords, useArrow=True))
