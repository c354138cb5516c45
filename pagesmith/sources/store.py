"""Keyed tables that survive runs: rows live in hash buckets, and a run rewrites only the buckets it touches.

A store is a folder of Parquet with one sub-folder per bucket.  An update reads the touched buckets, merges them with the
new rows, writes the result to the shared scratch folder first and then replaces just these buckets (dynamic partition
overwrite).  Files of other buckets stay as they are.  An update that fails can be run again: merging the same rows
twice gives the same store.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesmith.session import scratch_path

BUCKETS = 64
BUCKET = "store_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_store(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows of a store; none if it doesn't exist yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def update_store(new: DataFrame, path: str, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS) -> list[int]:
    """Merges ``new`` into the store: ``merge(stored rows of the touched buckets, new rows)`` gives their new rows.
    Returns the touched buckets.  The number of buckets belongs to the store and must not change; no new rows touch none."""
    spark, columns = new.sparkSession, new.columns
    incoming = scratch_path(spark, "store-new")
    new.withColumn(BUCKET, bucket_of(key, buckets)).write.parquet(incoming)
    schema = T.StructType([*new.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    new = spark.read.schema(schema).parquet(incoming)
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # at most one row per bucket
    if not touched:
        return []
    stored = read_store(spark, path, schema).where(F.col(BUCKET).isin(touched))  # only these folders are read
    merged = scratch_path(spark, "store-merged")
    merge(stored.select(columns), new.select(columns)).select(*columns, bucket_of(key, buckets).alias(BUCKET)).write.parquet(merged)
    back = spark.read.schema(schema).parquet(merged)
    back.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return touched


def replace_rows(key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A merge in which a new row replaces the stored one of its key."""
    def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
        return stored.join(new.select(key), key, "left_anti").select(stored.columns).unionByName(new)

    return merge
