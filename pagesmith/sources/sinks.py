"""Writers.  Output is overwritten, but for the object store, which keeps earlier runs; no file is named by a clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagesmith.operators.ordering import numbered
from pagesmith.sources import store

BATCH_ROWS = 50_000
OBJECT = "object_name string, url string, content_type string, content binary"


def batch_numbers(df: DataFrame, batch_size: int, order: list, whole: str | None = None, out: str = "batch") -> DataFrame:
    """``df`` with the batch (from 0) of every row: rows in ``order``, ``batch_size`` to a batch.  With ``whole``, rows of one value
    of that column (a page) stay together in the batch of the page's first row, so a batch may exceed its size by a
    part of its last page.  Rows are numbered over sorted ranges; no task sees them all."""
    terms = [F.asc_nulls_first(c) for c in ([whole] if whole else []) + [c for c in order if c != whole]]
    row = "row_no"
    while row in df.columns:
        row += "_"
    rows = numbered(df, terms, row)
    if whole:
        first = rows.groupBy(F.col(whole).alias("whole_")).agg(F.min(row).alias("first_"))
        rows = rows.join(first, F.col(whole).eqNullSafe(F.col("whole_"))).withColumn(row, F.col("first_")).drop("whole_", "first_")
    return rows.withColumn(out, F.floor((F.col(row) - 1) / batch_size)).drop(row)


def sink_json_batches(df: DataFrame, path: str, batch_size: int = BATCH_ROWS, order: list | None = None, whole: str | None = None) -> str:
    """K1: JSON Lines, non-ASCII kept, nulls written.  Without ``order``: files of at most ``batch_size`` rows that follow the
    partitions.  With it: one folder ``batch=<n>`` with one file per batch of ``batch_numbers``, the same however the rows are
    partitioned; partitions are addressed by the batch, so each file is written by one task.  Neighbouring small batches share a
    task (of about ``BATCH_ROWS`` rows, once there are more batches than shuffle partitions): every task reports to the driver."""
    if order is None:
        out = df.write.option("maxRecordsPerFile", batch_size)
    else:
        numbers = batch_numbers(df, batch_size, order, whole)
        n = (numbers.agg(F.max("batch")).first()[0] or 0) + 1
        tasks = min(n, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * batch_size // BATCH_ROWS)))
        task = F.expr(f"cast(batch * {tasks} div {n} as int)")
        out = numbers.repartitionById(tasks, task).write.partitionBy("batch")
    out.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def sink_text_lines(df: DataFrame, col: str, path: str, null_text: str | None = None) -> str:
    """K2: one value per line.  NULLs are dropped, or written as ``null_text`` if given."""
    c = F.col(col).cast("string")
    out = df.select(F.coalesce(c, F.lit(null_text)).alias("value")) if null_text is not None \
        else df.filter(c.isNotNull()).select(c.alias("value"))
    out.write.mode("overwrite").text(path)
    return path


def sink_json_single(df: DataFrame, path: str, single_file: bool = False) -> str:
    """K3: the whole result as JSON under one directory; one file only on request (that funnels
    the result through one task, so only for small results)."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite") \
        .option("ignoreNullFields", False).json(path)
    return path


def sink_stored_objects(df: DataFrame, path: str) -> str:
    """K4: stored responses as one Parquet table (object_name, url, content_type, content),
    instead of one small file per URL."""
    df.select("object_name", "url", "content_type", "content").write.mode("overwrite").parquet(path)
    return path


def sink_object_store(df: DataFrame, path: str, buckets: int = store.BUCKETS) -> list[int]:
    """K4 over runs: objects of earlier runs stay, an object of the same name is replaced.  Returns the rewritten buckets.
    ``df`` has one row per name (see ``fetch.latest_object``); null names are left out."""
    new = df.where("object_name is not null").select("object_name", "url", "content_type", "content")
    return store.update_store(new, path, "object_name", store.replace_rows("object_name"), buckets)


def scan_object_store(spark: SparkSession, path: str) -> DataFrame:
    """(object_name, url, content_type, content) of everything that runs have stored."""
    return store.read_store(spark, path, OBJECT)
