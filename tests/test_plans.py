"""Physical-plan checks: pruning before Python, bounded broadcasts, no Cartesian products."""

import os

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_products(spark):
    for k in ("reconcile_uploaded", "reconcile_missing", "paginate_urls", "retry_outcome", "lookup_extension",
              "extract_fields", "object_name_collisions"):
        p = plan(E.queries()[k](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k


def test_language_scoring_is_local_to_a_row(spark):
    p = plan(E.queries()["detect_language"](spark, SF))
    assert "ArrowEvalPython" in p and "Exchange" not in p


def test_no_window_of_the_store_plan_sees_bodies(spark):
    from pagesmith.operators import fetch
    from pagesmith.plans import fixtures as fx
    lines = plan(fetch.store_plan(fx.attempts(spark, SF))).split("\n")
    assert not any("Window" in x and "content#" in x for x in lines)


def test_job_language_never_shuffles_the_abstract(spark):
    from pagesmith.operators import langid
    from pagesmith.plans import fixtures as fx
    prof = langid.train_profile(fx.language_training(spark, SF))
    p = plan(langid.detect_language(fx.articles_lang(spark, SF), prof, "title"))
    assert "Exchange" not in p


def test_page_extraction_reads_two_columns(spark):
    p = plan(E.queries()["extract_records"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p


def test_entry_runs(spark):
    df = E.entry(spark)
    assert sorted(df.columns) == ["language", "n", "n_reference"]
    assert df.count() >= 1


def test_extension_lookup_broadcasts_fixed_tables(spark):
    p = plan(E.queries()["lookup_extension"](spark, SF))
    assert p.count("BroadcastHashJoin") >= 2


def test_results_independent_of_partition_count(spark):
    keys = ("retry_outcome", "latest_object", "language_counts", "paginate_urls", "reconcile_uploaded")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        runs = []
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            runs.append({k: sorted(map(tuple, E.queries()[k](spark, SF).collect()), key=repr) for k in keys})
        assert runs[0] == runs[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_language_counts_sum_to_rows(spark):
    from pagesmith.plans import fixtures as fx
    counts = E.queries()["language_counts"](spark, SF)
    assert counts.groupBy().sum("n").first()[0] == fx.articles_lang(spark, SF).count()
