from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pagesmith.functions import (content_type_ext, language_label, object_name, page_count, parse_grouped_int,
                                 path_basename, record_display, sanitize_text, slugify, slugify_unicode,
                                 url_insert_page, url_prefix)


def one(spark, col_expr, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_expr).collect()]


def test_page_count(spark):
    assert one(spark, page_count("v"), [0, 24, 25, 3159, None], "v int") == [0, 1, 2, 132, None]


def test_url_insert_page_separators(spark):
    got = one(spark, url_insert_page("v", F.lit(7)), ["/tr/search?q=&x=1", "/tr/list", "/search/a/search", "/search"])
    assert got == ["/tr/search/7?q=&x=1", None, None, "/search/7"]


def test_url_prefix_and_basename(spark):
    assert one(spark, url_prefix("v", "https://h"), ["/a"]) == ["https://h/a"]
    assert one(spark, path_basename("v"), ["a/b/c.pdf", "c", "a/"]) == ["c.pdf", "c", ""]


def test_sanitize_unicode_strip(spark):
    s = "  a\tb\nc 　\x1c"
    assert one(spark, sanitize_text("v"), [s, "\r\nx\r", None]) == [s.strip().replace("\n", " ").replace("\t", " "),
                                                                      "x", None]


def test_parse_grouped_int(spark):
    assert one(spark, parse_grouped_int("v"), ["3.159", " 12 ", "", "x", None, "1.000.000"]) == \
        [3159, 12, None, None, None, 1000000]


def test_content_type_ext_parameters_and_case(spark):
    vals = ["text/html", "text/html; charset=UTF-8", "text/html; charset=utf-8", "Application/PDF",
            "application/pdf;charset=UTF-8", "x/unknown", None, "image/vnd.djvu"]
    assert one(spark, content_type_ext("v"), vals) == [".html", ".html", ".txt", ".pdf", ".txt", ".txt", None, ".djvu"]
    assert one(spark, content_type_ext("v", normalize=True), vals)[2] == ".html"


def test_object_name(spark):
    df = spark.createDataFrame([("https://example.org/a?b=1", "application/pdf")], "u string, c string")
    assert df.select(object_name("u", "c")).first()[0] == "httpsexampleorgab1.pdf"


def test_language_label(spark):
    assert one(spark, language_label("v"), ["Language.TURKISH", "tr", None, "EN", "klingon"]) == \
        ["turkish", "turkish", None, "english", "klingon"]


def test_record_display(spark):
    df = spark.createDataFrame([("a", 3), (None, None)], "n string, c int")
    assert [r[0] for r in df.select(record_display("n", "c")).collect()] == ["a (3)", "None (None)"]


def test_slug_examples(spark):
    vals = ["Hello World!", "  --a__b--  ", "ışğçöüəİ", "ﬁ½㎏", "𝐀𝐁 c", None, "", "a - _ -b", "über-Straße 2"]
    assert one(spark, slugify("v"), vals) == ["hello-world", "a__b", "sgcoui", "fi12kg", "ab-c", "none", "", "a-_-b", "uber-strae-2"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=20), min_size=1, max_size=30))
def test_slug_properties(spark, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) <= 0xDFFF for c in t)]
    if not texts:
        return
    got = one(spark, slugify("v"), texts)
    assert all(set(g) <= set("abcdefghijklmnopqrstuvwxyz0123456789_-") for g in got)
    assert not any("--" in g or g != g.strip("-_") for g in got)
    assert one(spark, slugify("v"), got) == got  # idempotent
    ascii_words = [t for t in texts if t.isascii() and t.isalnum()]
    assert one(spark, slugify("v"), ascii_words) == [t.lower() for t in ascii_words] if ascii_words else True


def test_slug_unicode(spark):
    assert one(spark, slugify_unicode("v"), ["Ｈéllo  Wörld--"]) == ["héllo-wörld"]


def test_failfast_modes(spark):
    import pytest
    df = spark.createDataFrame([("/a/b",)], "v string")
    with pytest.raises(Exception):
        df.select(url_insert_page("v", F.lit(1), failfast=True)).collect()
    bad = spark.createDataFrame([("x.1",)], "v string")
    with pytest.raises(Exception):
        bad.select(parse_grouped_int("v", failfast=True)).collect()
