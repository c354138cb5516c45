"""Record projections, filters, unions and small aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesmith.functions.urls import path_basename

LANGUAGE_WHITELIST = ("turkish",)


def project_records(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select to a declared record type in its field order; missing fields become NULL,
    unknown ones are dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def project_info_urls(articles: DataFrame) -> DataFrame:
    """Only info_url, duplicates kept."""
    return articles.select("info_url")


def filter_language(df: DataFrame, whitelist=LANGUAGE_WHITELIST, col: str = "language") -> DataFrame:
    """Keep rows whose language is in the whitelist; NULL is never kept."""
    return df.filter(F.col(col).isin(list(whitelist)))


def nonempty(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != "")


def filter_nonempty_url(df: DataFrame, col: str = "url") -> DataFrame:
    """P5: keep non-empty URLs (no trimming: ' ' is kept)."""
    return df.filter(nonempty(col))


def filter_object_names(df: DataFrame, col: str = "name") -> DataFrame:
    """Object names inside a folder that are not folder markers -> base name."""
    c = F.col(col)
    return df.filter(c.contains("/") & ~c.endswith("/")).select(path_basename(c).alias("name"))


def filter_ok_status(df: DataFrame, col: str = "status") -> DataFrame:
    """Only HTTP 200 counts as a success."""
    return df.filter(F.col(col) == 200)


def union_batches(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; missing columns filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def language_counts(df: DataFrame, col: str = "language") -> DataFrame:
    """A1: rows per language over all rows; NULL is its own group.  ``n_reference`` is the
    count the original script printed (it started each key at 0)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .select(col, "n", (F.col("n") - 1).alias("n_reference"))


def batch_row_counts(df: DataFrame, file_col: str | list[str] = "file_name") -> DataFrame:
    """A3: rows per input batch file (``file_col`` may list extra columns fixed per file)."""
    cols = [file_col] if isinstance(file_col, str) else list(file_col)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
