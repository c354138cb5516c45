import pytest
from pyspark.sql import functions as F

from pagesmith.operators import htmltree as H
from pagesmith.operators import markup as M


def pages(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page_id bigint, html string")


CARD = ('<div class="card article-card dp-card-outline"><h5 class="card-title"><a href="/a/{i}">\n T{i}\t</a></h5>'
        '<div class="card-text article-text-block"> x&amp;y </div></div>')


def test_cards_and_all_null_card_kept(spark):
    html = CARD.format(i=1) + '<div class="card article-card dp-card-outline"><p>nothing</p></div>'
    rows = M.extract_articles(pages(spark, html)).orderBy("record_no").collect()
    assert [(r.title, r.info_url, r.abstract) for r in rows] == [("T1", "/a/1", "x&y"), (None, None, None)]


def test_class_token_vs_whole_string():
    root = H.parse('<div class="b a">1</div><div class="a b">2</div><div class="a  b">3</div>')
    assert [n.text() for n in H.find_all(root, H.compile_step('div[class="a b"]'))] == ["2", "3"]
    assert [n.text() for n in H.find_all(root, H.compile_step('div[class="a"]'))] == ["1", "2", "3"]


def test_nested_records_and_tree_rules():
    root = H.parse('<div class="r"><div class="r">in</div>out</div>')
    assert [n.text() for n in H.find_all(root, H.compile_step('div[class="r"]'))] == ["inout", "in"]
    root = H.parse('<p><b>a<br><p>b</p><p>c</p></article><script>var x="</p>";</script><p>d</p>')
    first = H.find(root, H.compile_step("p"))
    assert first.text() == "abcd"  # unclosed <b> keeps later paragraphs inside the first
    assert "var" not in root.text()


def test_missing_attribute_permissive_and_failfast(spark):
    html = '<div class="card article-card dp-card-outline"><h5 class="card-title"><a>t</a></h5></div>'
    r = M.extract_articles(pages(spark, html)).first()
    assert (r.title, r.info_url) == ("t", None)
    with pytest.raises(Exception):
        M.extract_articles(pages(spark, html), mode=M.FAILFAST).collect()


def test_facets_only_hidden_items(spark):
    html = ('<div class="kt-widget-18"><div class="kt-widget-18__item"><a href="/v">Visible</a>'
            '<div class="kt-widget-18__orders">9</div></div>'
            '<div class="kt-widget-18__item kt-hidden more-item"><a href="/en/search?q=&amp;j=1">\n J </a>'
            '<div class="kt-widget-18__orders"> 3.159 </div></div>'
            '<div class="kt-widget-18__item kt-hidden more-item"><a href="/x">E</a>'
            '<div class="kt-widget-18__orders"></div></div></div>')
    rows = M.extract_facets(pages(spark, html)).orderBy("record_no").collect()
    assert [(r.name, r.url, r.article_count) for r in rows] == [("J", "/en/search?q=&j=1", 3159), ("E", "/x", None)]


def test_meta_links_and_misses(spark):
    df = spark.createDataFrame([
        ("a.html", '<meta name="citation_pdf_url" content="u.pdf"><meta name="citation_pdf_url" content="v">'),
        ("b.html", '<meta name="citation_pdf_url" content="">'),
        ("c.html", '<meta name="citation_pdf_url">'),
        ("d.html", "<p>none</p>"), ("e.html", None)], "filename string, html string")
    assert [tuple(r) for r in M.extract_meta_link(df).collect()] == [("a.html", "u.pdf")]
    assert sorted(r[0] for r in M.extraction_misses(df).collect()) == ["b.html", "c.html", "d.html", "e.html"]


def test_read_schema_pruned_before_python(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "u", "<li><a href='x'>y</a></li>", "big")],
                          "page_id bigint, url string, html string, other string").write.parquet(path)
    recs = M.extract_records(spark.read.parquet(path), (M.Field("t", ("a",), "text"),), "li")
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan
    assert recs.collect()[0]["t"] == "y"


def test_bad_page_goes_to_errors(spark):
    df = pages(spark, "<li><a>ok</a></li>")
    errs = M.extraction_errors(df, (M.Field("t", ("a",), "text"),), "li")
    assert errs.count() == 0


def test_container_text_excluded_at_any_depth():
    root = H.parse("<div>a<template><p>t</p></template><ruby>b<rt>r</rt></ruby><style>s</style>c</div>")
    div = H.find(root, H.compile_step("div"))
    assert div.text() == "abc"
    assert H.find(root, H.compile_step("rt")).text() == "r"


def test_keys_come_out_as_they_went_in(spark):
    df = spark.createDataFrame([(None, CARD.format(i=1)), (9007199254740993, CARD.format(i=2))], "page_id bigint, html string").coalesce(1)
    assert {r.page_id for r in M.extract_articles(df).collect()} == {None, 9007199254740993}


def test_rejected_page_is_a_miss(spark, monkeypatch):
    df = spark.createDataFrame([("bad.html", '<![foo[x]]><meta name="citation_pdf_url" content="u.pdf">'),
                                ("good.html", '<meta name="citation_pdf_url" content="u.pdf">'), ("none.html", None)],
                               "filename string, html string")
    links = {r.filename for r in M.extract_meta_link(df).collect()}
    misses = {r.filename for r in M.extraction_misses(df).collect()}
    assert "good.html" in links and links | misses == {"bad.html", "good.html", "none.html"} and not links & misses


def test_building_a_plan_runs_nothing(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    grouped = spark.createDataFrame([(1, CARD.format(i=1))], "page_id bigint, html string").groupBy("page_id").agg(F.max("html").alias("html"))
    M.extract_articles(grouped)
    assert not tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_invalid_bytes_are_a_rejected_page(spark):
    pages = spark.createDataFrame([(1, bytearray(b"<h1>caf\xe9</h1>")), (2, bytearray("<h1>café</h1>".encode()))], "page_id long, html binary")
    pages = pages.selectExpr("page_id", "cast(html as string) as html")
    field = (M.Field("title", ("h1",)),)
    assert [(r.page_id, r.title) for r in M.extract_records(pages, field).collect()] == [(2, "café")]
    assert [(r.page_id, r._error[:18]) for r in M.extraction_errors(pages, field).collect()] == [(1, "UnicodeDecodeError")]
    with pytest.raises(Exception, match="UnicodeDecodeError"):
        M.extract_records(pages, field, mode="FAILFAST").collect()
