import json
import os

from pyspark.sql import functions as F

from pagesmith import schemas
from pagesmith.sources import files, sinks


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_scan_html_pages_not_recursive(spark, tmp_path):
    d = str(tmp_path / "html")
    write(d, "a.html", "<h1>A</h1>\n<p>x</p>\n")
    write(d, "b.htm", "<h1>B</h1>")
    write(d + "/sub", "c.html", "<h1>C</h1>")
    rows = files.scan_html_pages(spark, d).collect()
    assert [(r.file_name, r.html) for r in rows] == [("a.html", "<h1>A</h1>\n<p>x</p>\n")]


def test_scan_json_batches_array_and_lines(spark, tmp_path):
    d = str(tmp_path / "arr")
    write(d, "b1.json", json.dumps([{"title": "t", "info_url": "u", "abstract": None, "extra": 1},
                                    {"title": "ş", "info_url": "v"}], indent=4, ensure_ascii=False))
    write(d, "skip.txt", "[]")
    df = files.scan_json_batches(spark, d, schemas.ARTICLE_LANG)
    assert sorted(tuple(r) for r in df.collect()) == [("t", "u", None, None), ("ş", "v", None, None)]
    strict = files.scan_json_batches(spark, d, schemas.ARTICLE, required=["abstract"])
    assert strict.count() == 0
    import pytest
    with pytest.raises(Exception):
        files.scan_json_batches(spark, d, schemas.ARTICLE, required=["abstract"], on_missing="fail").collect()
    assert files.scan_json_batches(spark, d, schemas.ARTICLE, required=["title"], on_missing="fail").count() == 2
    out = str(tmp_path / "lines")
    sinks.sink_json_batches(df, out, batch_size=1)
    back = files.scan_json_batches(spark, out, schemas.ARTICLE_LANG, layout="lines", with_file=True)
    assert back.count() == 2 and back.select("file_name").distinct().count() == 2


TOLERANT = {  # text, values kept before the first error, error
    "good.json": ('[{"url": "a"}, {"url": ""}, {"filename": "x"}, {"url": null}]', ["a", "", None, None], None),
    "trunc.json": ('[{"url": "b"}, {"url": ', [], "malformed JSON"),
    "null.json": ('[{"url": "c"}, null, {"url": "never"}]', ["c"], "bad item"),
    "seven": ('[{"url": "d"}, 7]', ["d"], "bad item"),
    "falsy": ('[{"url": 0}, {"url": false}, {"url": []}, {"url": {}}, {"url": "e"}, {"url": 5}, {"url": "never"}]', [None] * 4 + ["e"], "bad item"),
    "true": ('[{"url": "f"}, {"url": true}]', ["f"], "bad item"),
    "list": ('[{"url": "g"}, {"url": ["h"]}]', ["g"], "bad item"),
    "obj.txt": ('{"url": "i"}', [], "not an array of objects"),
    "num": ("7", [], "not an array of objects"),
    "after": ('[{"url": "j"}] x', [], "malformed JSON"),
    "empty": ("", [], "malformed JSON"),
    "nothing": (" {} ", [], None),
    "none": ("[]", [], None),
    "_under.json": ('[{"url": "k"}]', ["k"], None),
    ".dot": ('[{"url": "l"}, null]', ["l"], "bad item"),
}


def test_scan_json_tolerant_keeps_items_before_a_bad_one(spark, tmp_path):
    d = str(tmp_path / "tol")
    for name, (content, _, _) in TOLERANT.items():
        write(d, name, content)
    with open(os.path.join(d, "latin"), "wb") as f:
        f.write('[{"url": "é"}]'.encode("latin-1"))
    write(d + "/_folder", "x.json", "[]")
    rows, errors = files.scan_json_tolerant(spark, d, "url")
    got = {}
    for r in sorted(rows.collect(), key=lambda r: (r.file_name, r.pos)):
        got.setdefault(r.file_name, []).append(r.url)
    assert got == {k: urls for k, (_, urls, _) in TOLERANT.items() if urls}
    assert {r.file_name: r.error for r in errors.collect()} == {"latin": "invalid UTF-8"} | {k: e for k, (_, _, e) in TOLERANT.items() if e}


def test_every_html_file_is_read_or_rejected(spark, tmp_path):
    d = str(tmp_path / "html")
    write(d, "_x.html", "<h1>hidden é</h1>")
    write(d, "empty.html", "")
    write(d, "plain.html", "<h1>plain</h1>")
    write(d, "_other.txt", "")
    with open(os.path.join(d, "bad.html"), "wb") as f:
        f.write(b"<h1>caf\xe9</h1>")
    assert {r.file_name: r.html for r in files.scan_html_pages(spark, d).collect()} == {
        "_x.html": "<h1>hidden é</h1>", "empty.html": "", "plain.html": "<h1>plain</h1>"}
    assert [tuple(r) for r in files.html_rejects(spark, d).collect()] == [("bad.html", "invalid UTF-8")]
    assert {r.file_name for r in files.whole_files(spark, d, ".html", every=False).collect()} == {"plain.html", "bad.html"}


def test_the_driver_holds_no_list_of_a_folder(spark, tmp_path):
    d, tracker = str(tmp_path / "html"), spark.sparkContext.statusTracker()
    for n in range(300):
        write(d, f"p{n}.html", f"<h1>{n}</h1>")
    spark.sparkContext.setJobGroup("folder", "")
    try:
        pages = files.scan_html_pages(spark, d)
        assert {(r.file_name, r.html) for r in pages.collect()} == {(f"p{n}.html", f"<h1>{n}</h1>") for n in range(300)}
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(pages.inputFiles()) < 10  # the plan's file index had all 300
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("folder") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 4  # shuffle partitions here


def test_odd_names_are_read_as_by_spark(spark, tmp_path):
    import bz2
    import gzip
    d = str(tmp_path / "odd dir%20")
    for name in ("a b.html", "a%20b.html", "é.html", "q?x.html", "[b].html", "t~'()*!$&+,;@=.html", "nl\nx.html", "e\u00a0f.html", "x.htm", "y.html._COPYING_"):
        write(d, name, name)
    for name, packed in (("g.html.gz", gzip.compress), ("b.html.bz2", bz2.compress)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(packed(b"one") + packed(b"two"))
    for suffix in (".html", "", ".htm?", "{.gz,.bz2}"):
        got, want = (sorted(map(tuple, files.whole_files(spark, d, suffix, every).collect())) for every in (True, False))
        assert got == want and got
    write(d, "_x=1.html", "once")  # Spark's readers take this one
    assert [r.value for r in files.whole_files(spark, d, "x=1.html").collect()] == ["once"]


def test_partition_folders_give_columns(spark, tmp_path):
    d = str(tmp_path / "parts")
    write(d + "/k=1", "a.html", "a")
    write(d + "/k=2", "b.html", "b")
    write(d, "_c.html", "c")
    df = files.whole_files(spark, d, ".html")
    assert df.columns == ["k", "path", "file_name", "value"]
    assert {(r.k, r.file_name, r.value) for r in df.collect()} == {(1, "a.html", "a"), (2, "b.html", "b"), (None, "_c.html", "c")}


def test_no_folder_and_an_empty_one(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        files.scan_html_pages(spark, str(tmp_path / "none"))
    os.makedirs(tmp_path / "empty")
    assert files.scan_html_pages(spark, str(tmp_path / "empty")).collect() == []


def test_links_of_a_folder_hold_no_list_in_the_driver(spark, tmp_path):
    from pagesmith.plans import jobs
    d = str(tmp_path / "html")
    for n in range(60):
        meta = f'<meta name="citation_pdf_url" content="/{n}.pdf">' if n % 3 else "<p>none</p>"
        write(d, f"p{n}.html", meta)
    with open(os.path.join(d, "bad.html"), "wb") as f:
        f.write(b"<h1>caf\xe9</h1>")
    res = jobs.job_download_links_from_files(spark, d, str(tmp_path / "links"))
    assert {(r.filename, r.url) for r in res["links"].collect()} == {(f"p{n}.html", f"/{n}.pdf") for n in range(60) if n % 3}
    assert sorted(r.filename for r in res["misses"].collect()) == sorted([f"p{n}.html" for n in range(60) if n % 3 == 0] + ["bad.html"])
    assert [tuple(r) for r in res["rejects"].collect()] == [("bad.html", "invalid UTF-8")]
    assert not any(x.endswith(".html") for x in res["misses"].inputFiles())


def test_scan_url_list_blank_lines(spark, tmp_path):
    d = str(tmp_path / "u")
    write(d, "urls.txt", "  http://a \n\n\thttp://b\r\n   \n")
    assert [r.url for r in files.scan_url_list(spark, d).collect()] == ["http://a", "", "http://b", ""]
    assert [r.url for r in files.scan_url_list(spark, d, drop_blank=True).collect()] == ["http://a", "http://b"]


def test_scan_manifest_from_files_and_listing(spark, tmp_path):
    root = str(tmp_path / "bucket")
    write(root + "/corpus", "x.pdf", "1")
    write(root + "/corpus/sub", "y.pdf", "2")
    write(root, "top.pdf", "3")
    names = sorted(r.name for r in files.scan_manifest(spark, root=root, prefix="corpus/").collect())
    assert names == ["corpus/sub/y.pdf", "corpus/x.pdf"]
    listing = spark.createDataFrame([("corpus/a",), ("other/b",)], "name string")
    assert [r.name for r in files.scan_manifest(spark, listing=listing, prefix="corpus/").collect()] == ["corpus/a"]


def test_sinks_text_and_single(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "info_url string")
    out = str(tmp_path / "t")
    sinks.sink_text_lines(df, "info_url", out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a", "b"]
    sinks.sink_text_lines(df, "info_url", out, null_text="None")
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["None", "a", "b"]
    one = str(tmp_path / "one")
    sinks.sink_json_single(df.repartition(3), one, single_file=True)
    assert len([f for f in os.listdir(one) if f.endswith(".json")]) == 1


def test_stored_objects_table(spark, tmp_path):
    df = spark.createDataFrame([("n.pdf", "u", "application/pdf", bytearray(b"%PDF"))],
                               "object_name string, url string, content_type string, content binary")
    out = str(tmp_path / "o")
    sinks.sink_stored_objects(df, out)
    assert bytes(spark.read.parquet(out).first().content) == b"%PDF"


def test_malformed_json_is_never_a_record(spark, tmp_path):
    import pytest
    d = str(tmp_path / "bad")
    write(d, "a.json", '{"title": "t", "info_url": "u"}\n{"title": "cut\n')
    assert [r.title for r in files.scan_json_batches(spark, d, schemas.ARTICLE, layout="lines").collect()] == ["t"]
    assert [(r.file_name, r.record) for r in files.json_rejects(spark, d, schemas.ARTICLE, layout="lines").collect()] == [
        ("a.json", '{"title": "cut')]
    with pytest.raises(Exception):
        files.scan_json_batches(spark, d, schemas.ARTICLE, layout="lines", mode="FAILFAST").collect()
    assert files.scan_json_batches(spark, d, schemas.ARTICLE, layout="lines").count() == 1
