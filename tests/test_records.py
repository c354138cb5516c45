from pagesmith import schemas
from pagesmith.operators import records


def test_filter_nonempty_url_keeps_space(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "url string")
    assert sorted(r.url for r in records.filter_nonempty_url(df).collect()) == [" ", "a"]


def test_language_counts_null_group_and_whitelist(spark):
    df = spark.createDataFrame([("turkish",), (None,), (None,), ("english",)], "language string")
    counts = {r.language: (r.n, r.n_reference) for r in records.language_counts(df).collect()}
    assert counts == {"turkish": (1, 0), None: (2, 1), "english": (1, 0)}
    assert [r.language for r in records.filter_language(df).collect()] == ["turkish"]


def test_project_records_fills_and_drops(spark):
    df = spark.createDataFrame([("t", "x", 1)], "title string, other string, n int")
    out = records.project_records(df, schemas.ARTICLE_LANG)
    assert out.columns == ["title", "info_url", "abstract", "language"] and tuple(out.first()) == ("t", None, None, None)


def test_union_batches_missing_columns(spark):
    a = spark.createDataFrame([("t", "en")], "title string, language string")
    b = spark.createDataFrame([("u",)], "title string")
    assert sorted(map(tuple, records.union_batches(a, b).collect()), key=repr) == [("t", "en"), ("u", None)]
