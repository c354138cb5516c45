from pyspark.sql import functions as F

from pagesmith.operators import pagination


def pubs(spark):
    return spark.createDataFrame([("a", "/tr/search?j=1", 49), ("b", "/tr/search?j=2", 0), ("c", "/bad", 5),
                                  ("d", "/tr/search?j=4", None), ("e", "/search/x/search", 3)],
                                 "name string, url string, article_count int")


def test_pages_per_publisher(spark):
    rows = pagination.paginate_urls(pubs(spark), prefix="https://h").orderBy("page").collect()
    assert [r.page_url for r in rows] == ["https://h/tr/search/1?j=1", "https://h/tr/search/2?j=1",
                                          "https://h/tr/search/3?j=1"]
    bad = {r.name for r in pagination.invalid_publisher_urls(pubs(spark)).collect()}
    assert bad == {"c", "e"}


def test_chunking_does_not_change_result(spark):
    df = spark.createDataFrame([("big", "/search?x", 24 * 1000 + 1), ("s", "/search?y", 24)],
                               "name string, url string, article_count int")
    a = pagination.paginate_urls(df, pages_per_chunk=7)
    b = pagination.paginate_urls(df, pages_per_chunk=100000)
    assert a.count() == 1002 and a.exceptAll(b).count() == 0
    assert a.groupBy("url").agg(F.max("page").alias("m")).orderBy("url").collect()[0].m == 1001


def test_chunks_are_expanded_by_many_tasks(spark):
    df = spark.createDataFrame([("big", "/search?x", 24 * 100_000)], "name string, url string, article_count int")
    out = pagination.paginate_urls(df, pages_per_chunk=100, partitions=16)
    used = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used >= 8 and out.count() == 100_000
