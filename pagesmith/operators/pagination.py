"""G1: publisher rows -> one listing URL per result page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.functions.urls import PAGE_SIZE, SEARCH_SEGMENT, page_count, url_insert_page, url_prefix

PAGES_PER_CHUNK = 10_000


def _valid(url_col: str, sep: str):
    return F.size(F.split(F.col(url_col), "\\Q" + sep + "\\E", -1)) == 2


def paginate_urls(publishers: DataFrame, prefix: str = "", page_size: int = PAGE_SIZE,
                  count_col: str = "article_count", url_col: str = "url", sep: str = SEARCH_SEGMENT,
                  pages_per_chunk: int = PAGES_PER_CHUNK, partitions: int | None = None) -> DataFrame:
    """(name, url, page, page_url) for pages 1..ceil(count/page_size) of every publisher.

    Publishers with count 0 or NULL give no URL.  URLs without exactly one ``sep`` are left out
    (see ``invalid_publisher_urls``).  Page ranges are first cut into chunks, and the chunk rows are dealt by
    hash to ``partitions`` tasks (default: the session's shuffle partitions; a given number isn't coalesced
    although chunk rows are tiny), so one publisher with a huge count is expanded by many tasks.
    """
    n = partitions or int(publishers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = publishers.filter(_valid(url_col, sep)).select(
        "name", url_col, page_count(F.col(count_col), page_size).alias("_pages"))
    p = p.filter(F.col("_pages") >= 1)
    chunks = p.select("name", url_col, "_pages", F.explode(
        F.sequence(F.lit(0), ((F.col("_pages") - 1) / pages_per_chunk).cast("bigint"))).alias("_chunk"))
    chunks = chunks.repartition(n, url_col, "_chunk")
    first = F.col("_chunk") * pages_per_chunk + 1
    last = F.least(F.col("_chunk") * pages_per_chunk + pages_per_chunk, F.col("_pages"))
    pages = chunks.select("name", url_col, F.explode(F.sequence(first, last)).alias("page"))
    return pages.select("name", url_col, "page",
                        url_prefix(url_insert_page(url_col, "page", sep), prefix).alias("page_url"))


def invalid_publisher_urls(publishers: DataFrame, url_col: str = "url", sep: str = SEARCH_SEGMENT) -> DataFrame:
    """Reject table: publishers whose URL has no or several ``sep`` parts."""
    return publishers.filter(~_valid(url_col, sep) | F.col(url_col).isNull())
