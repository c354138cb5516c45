"""Batches of a defined size, the SQL table function, and the incremental job."""

import json
import os
import random

import pytest

from pagesmith import schemas, session
from pagesmith.operators import markup
from pagesmith.plans import jobs
from pagesmith.sources import files, sinks


def brute_batches(rows, size, whole):
    """rows (page, n) in order -> batch of each; with ``whole`` the batch of the page's first row."""
    first, out = {}, []
    for k, (page, _) in enumerate(rows):
        out.append(first.setdefault(page, k) // size if whole else k // size)
    return out


@pytest.mark.parametrize("size, whole, parts", [(1, False, 1), (7, False, 5), (7, True, 3), (100, True, 2), (7, True, 1)])
def test_batches_do_not_depend_on_partitions(spark, tmp_path, size, whole, parts):
    rng = random.Random(size)
    rows = [(p, n) for p in [None, *range(30)] for n in range(rng.randint(0, 9))]
    want = {r: b for r, b in zip(rows, brute_batches(rows, size, whole))}
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "page int, n int").repartition(parts)
    out = str(tmp_path / "b")
    if whole:
        sinks.sink_json_batches(df, out, size, ["n"], "page")
    else:
        sinks.sink_json_batches(df, out, size, ["page", "n"])
    back = spark.read.schema("page int, n int, batch long").json(out)
    assert {(r.page, r.n): r.batch for r in back.collect()} == want
    for folder in os.listdir(out):
        if folder.startswith("batch="):
            assert len([f for f in os.listdir(os.path.join(out, folder)) if f.endswith(".json")]) == 1


def test_small_batches_share_tasks(spark, tmp_path):
    out = str(tmp_path / "b")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("small-batches", "")
    try:
        sinks.sink_json_batches(spark.range(200, numPartitions=2), out, 2, ["id"])
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    stages = {s for j in tracker.getJobIdsForGroup("small-batches") for s in tracker.getJobInfo(j).stageIds}
    # partitions: 4 of a shuffle here; every batch had its own task before
    assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) <= 4
    back = spark.read.schema("id long, batch long").json(out)
    assert back.count() == 200 and back.where("batch <> id div 2").count() == 0
    assert all(len([f for f in os.listdir(os.path.join(out, b)) if f.endswith(".json")]) == 1 for b in os.listdir(out) if b.startswith("batch="))


def test_many_paths_are_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    out, tracker, key = str(tmp_path / "b"), spark.sparkContext.statusTracker(), session.LISTING_TASKS
    sinks.sink_json_batches(spark.range(80), out, 2, ["id"])
    spark.sparkContext.setJobGroup("listing", "")
    try:
        files.scan_json_batches(spark, out, schemas.ARTICLE, layout="lines")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages) <= 4  # shuffle partitions here; 40 folders were 40 tasks
    during, sink = [], sinks.sink_json_batches
    monkeypatch.setattr(sinks, "sink_json_batches", lambda *a, **k: (during.append(spark.conf.get(key, None)), sink(*a, **k)))
    drop_pages(str(tmp_path / "html"), ["a"])
    assert jobs.job_articles_stream(spark, *(str(tmp_path / x) for x in ("html", "out", "checkpoint"))).count() == 2
    assert during and set(during) == {"4"} and spark.conf.get(key, None) is None


def test_no_task_of_the_numbering_sees_all_rows(spark):
    df = sinks.batch_numbers(spark.range(1000), 10, ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert df.where("batch <> id div 10").count() == 0


def test_an_empty_table_gives_no_batch(spark, tmp_path):
    sinks.sink_json_batches(spark.createDataFrame([], "n int"), str(tmp_path / "e"), 3, ["n"])
    assert spark.read.schema("n int").json(str(tmp_path / "e")).count() == 0


PAGE = '<ul><li><a href="/a">A &amp; b</a></li><li>plain</li></ul>'


def test_table_function_in_sql(spark):
    markup.register_sql(spark)
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>none</p>")], "page_id long, html string")
    sql = "SELECT p.page_id, r.* FROM {pages} p, LATERAL extract_records(p.html, 'li', 'text=a', 'href=a > @href') r"
    out = spark.sql(sql, pages=pages)
    assert out.columns == ["page_id", "record_no", "text", "href"]
    assert sorted(map(tuple, out.collect())) == [(1, 0, "A & b", "/a"), (1, 1, None, None)]
    whole = spark.sql("SELECT p.page_id, r.n FROM {pages} p, LATERAL extract_records(p.html, NULL, 'n=ul > li') r", pages=pages)
    assert sorted(map(tuple, whole.collect())) == [(1, "A & b"), (3, None)]
    for bad in ("extract_records(p.html, p.html, 'x=a')", "extract_records(p.html, 'li')", "extract_records(p.html, 'li', 'a')"):
        with pytest.raises(Exception):
            spark.sql(f"SELECT r.* FROM {{pages}} p, LATERAL {bad} r", pages=pages).collect()


CARD = ('<div class="card article-card dp-card-outline"><h5 class="card-title"><a href="/{0}">T{0}</a></h5>'
        '<div class="card-text article-text-block">text {0}</div></div>')


def drop_pages(folder, names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(os.path.join(folder, f"{n}.html"), "w") as f:
            f.write(CARD.format(n) + CARD.format(f"{n}b"))


def test_incremental_job_reads_every_file_once(spark, tmp_path):
    html, out, checkpoint = (str(tmp_path / x) for x in ("html", "out", "checkpoint"))
    with pytest.raises(ValueError):
        jobs.job_articles_stream(spark, html, out, "")
    titles = lambda df: sorted(r.title for r in df.collect())
    drop_pages(html, ["a", "c"])
    assert titles(jobs.job_articles_stream(spark, html, out, checkpoint, files_per_batch=1)) == ["Ta", "Tab", "Tc", "Tcb"]
    drop_pages(html, ["d"])
    with open(os.path.join(html, "bad.html"), "wb") as f:
        f.write(b"<p>caf\xe9</p>")
    got = titles(jobs.job_articles_stream(spark, html, out, checkpoint))
    assert got == titles(jobs.job_articles(spark, html, str(tmp_path / "once"))["articles"]) == ["Ta", "Tab", "Tc", "Tcb", "Td", "Tdb"]
    assert titles(jobs.job_articles_stream(spark, html, out, checkpoint)) == got  # a restart repeats no file
    rejects = spark.read.schema("path string, _error string").json(out + "-rejects").collect()
    assert [(os.path.basename(r.path), r._error[:18]) for r in rejects] == [("bad.html", "UnicodeDecodeError")]
    assert [r.file_name for r in jobs.job_articles(spark, html, str(tmp_path / "again"))["rejects"].collect()] == ["bad.html"]


def test_articles_in_batches_of_whole_pages(spark, tmp_path):
    html, out = str(tmp_path / "html"), str(tmp_path / "out")
    drop_pages(html, ["a", "b", "c", "_d", "e"])
    back = jobs.job_articles(spark, html, out, batch_size=3, ordered=True)["articles"]
    assert back.count() == 10
    sizes = {}
    for r in files.scan_json_batches(spark, out, schemas.ARTICLE, layout="lines").collect():
        sizes.setdefault(r.batch, []).append(r.title)
    # pages in the order of their paths: _d, a | b | c, e  (rows before them: 0, 2 | 4 | 6, 8)
    assert {b: len(v) for b, v in sizes.items()} == {0: 4, 1: 2, 2: 4}
    assert json.dumps(sorted(sizes[1])) == '["Tb", "Tbb"]'
