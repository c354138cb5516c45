import datetime as dt

from pyspark.sql import functions as F

from pagesmith.functions import content_type_ext
from pagesmith.operators import fetch

T0 = dt.datetime(2024, 1, 1)


def attempts(spark, rows):
    data = [(i, u, T0 + dt.timedelta(seconds=s), st, ct) for i, (u, s, st, ct) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, url string, fetched_at timestamp, status int, content_type string")


def test_outcome_states_and_limits(spark):
    rows = [("ok2", 1, 500, None), ("ok2", 2, 200, "text/html"), ("ok2", 3, 200, "text/html"),
            ("late", 1, 500, None), ("late", 2, 500, None), ("late", 3, 404, None), ("late", 4, 201, None),
            ("late", 5, 200, "text/html"),
            ("pend", 1, 503, None)]
    out = {r.url: r for r in fetch.retry_outcome(attempts(spark, rows)).collect()}
    assert (out["ok2"].state, out["ok2"].attempts_used, out["ok2"].success_id) == ("succeeded", 2, 1)
    assert (out["late"].state, out["late"].attempts_used) == ("failed", 4)  # 5th attempt is not allowed
    assert (out["pend"].state, out["pend"].attempts_used) == ("pending", 1)
    sched = {r.url: r for r in fetch.retry_schedule(fetch.retry_outcome(attempts(spark, rows))).collect()}
    assert list(sched) == ["pend"] and sched["pend"].delay_s == 0.0


def test_retry_delays(spark):
    for n, wait in ((1, 0.0), (2, 0.5), (3, 1.0)):
        rows = [("u", s, 500, None) for s in range(n)]
        r = fetch.retry_schedule(fetch.retry_outcome(attempts(spark, rows))).first()
        assert (r.retry_no, r.delay_s) == (n, wait)


def test_window_group_limit_in_plan(spark):
    plan = fetch.retry_outcome(attempts(spark, [("u", 1, 200, None)]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_object_and_collisions(spark):
    rows = [("https://e.org/a", 1, 200, "text/html"), ("https://e.org/a/", 2, 200, "text/html"),
            ("https://e.org/b", 3, 200, "application/pdf")]
    named = fetch.name_objects(attempts(spark, rows))
    latest = {r.object_name: r.url for r in fetch.latest_object(named).collect()}
    assert latest == {"httpseorga.html": "https://e.org/a/", "httpseorgb.pdf": "https://e.org/b"}
    col = fetch.object_name_collisions(named).collect()
    assert [(r.object_name, r.n_urls) for r in col] == [("httpseorga.html", 2)]


def test_progress(spark):
    rows = [("a", 1, 200, None), ("b", 1, 500, None), ("c", 1, 200, None)]
    p = fetch.download_progress(fetch.retry_outcome(attempts(spark, rows))).first()
    assert (p.done, p.total, p.percent) == (2, 3, 66.67)


def test_lookup_extension_equals_column_function(spark):
    cts = ["text/html", "TEXT/PLAIN", "x/y", None, "text/html; charset=UTF-8", "image/jpeg"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cts)], "id int, content_type string")
    a = {r.id: r.ext for r in fetch.lookup_extension(df).collect()}
    b = {r.id: r.e for r in df.select("id", content_type_ext("content_type").alias("e")).collect()}
    assert a == b
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the shuffled way
    try:
        assert {r.id: r.ext for r in fetch.lookup_extension(df).collect()} == b
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
