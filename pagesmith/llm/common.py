"""Helpers shared by the operators: intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagesmith.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, and a lost
    executor costs only a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(spark: SparkSession, *dfs: DataFrame | None) -> None:
    """Delete tables made by ``table`` that no later plan reads."""
    for df in dfs:
        path = getattr(df, "_scratch", None)
        if path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stripped(text: Column) -> Column:
    """The text without white space at its ends; empty for null."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))


def words(text: Column) -> Column:
    """The words of a text; a null or blank text has none.  White space is made spaces first: splitting at one
    character is faster than at a pattern.  The text is named once, so no plan evaluates it twice."""
    t = F.coalesce(text, F.lit(""))
    for c in "\n\t\r\x0b\f":
        t = F.replace(t, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(t, " "), "")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker: code is unpickled anew for every task."""
    name = "pagesmith_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


#: Rows up to which a written narrow table is broadcast (tens of megabytes); beyond, Spark shuffles.
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is small by count, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def hash_sample(df: DataFrame, rows: int, rank: str, groups: tuple[str, ...] = ()) -> DataFrame:
    """The ``rows`` rows of every group with the lowest ``rank`` (a hash, taken as unsigned, so any part of its range is a fair share).

    First the groups are counted and rows above a share that holds enough of them with near certainty are left out in the
    scan; only what remains, a little more than ``rows`` a group, is sorted, and so neither a task nor the driver sees
    more of a hot group.  (If a share held too few, all rows of its group are sorted.)  Null groups have none."""
    df = df.dropna(subset=list(groups)) if groups else df
    share = rows + 8 * rows ** 0.5 + 64
    sized_ = df.groupBy(*groups).agg(F.count("*").alias("all_")) if groups else df.agg(F.count("*").alias("all_"))
    sizes = [(*r[:-1], min(1.0, share / max(r["all_"], 1)), r["all_"]) for r in sized_.collect()]  # a row per group
    at, order = F.shiftrightunsigned(rank, 1).cast("double") / float(1 << 63), [F.shiftrightunsigned(rank, 1), F.col(rank)]
    if not groups:
        (cut, n), = sizes
        low = df.where(at <= cut)
        low = low if low.count() >= min(rows, n) else df
        return low.orderBy(*order).limit(rows)
    cut = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in groups)
    limits = df.sparkSession.createDataFrame([x[:-1] for x in sizes], f"{cut}, cut_ double")
    low = df.join(F.broadcast(limits), list(groups)).where(at <= F.col("cut_")).drop("cut_")
    held = {tuple(r[:-1]): r["n_"] for r in low.groupBy(*groups).agg(F.count("*").alias("n_")).collect()}
    if any(held.get(tuple(x[:-2]), 0) < min(rows, x[-1]) for x in sizes):
        low = df
    k = free_name(df, "k")
    w = Window.partitionBy(*groups).orderBy(*order)
    return low.withColumn(k, F.row_number().over(w)).where(F.col(k) <= rows).drop(k)
