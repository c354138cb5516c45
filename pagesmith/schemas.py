"""Record types carried between the jobs (one StructType per record kind)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

PUBLISHER = T.StructType([
    T.StructField("name", S), T.StructField("url", S), T.StructField("article_count", T.IntegerType()),
])
ARTICLE = T.StructType([
    T.StructField("title", S), T.StructField("info_url", S), T.StructField("abstract", S),
])
ARTICLE_LANG = T.StructType(ARTICLE.fields + [T.StructField("language", S)])
DOWNLOAD_LINK = T.StructType([T.StructField("filename", S), T.StructField("url", S)])
