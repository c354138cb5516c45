"""Connected components as DataFrame jobs: alternating large-star and small-star steps.

Each step replaces a node's neighbours by the smallest node it knows, so a component becomes a star
around its smallest node after a number of steps logarithmic in its size.  Only (node, node) pairs
are shuffled, minima are pre-aggregated on the map side, and every step ends in a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import drop, table


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    side = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return side.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def _mark(e: DataFrame):
    """A digest of a set of edges: equal before and after a step once nothing moves any more."""
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge to another node; component is the smallest
    node reachable.  Nodes without such an edge are left out (their component is themselves).

    Null ends, self-loops, repeated edges and both directions are allowed; no edges give no rows.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    e = table(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    mark = _mark(e)
    while mark[0]:
        nxt = table(_small_star(_large_star(e)), "cc-step")
        now = _mark(nxt)
        drop(spark, e)
        e, same, mark = nxt, now == mark, now
        if same:
            break
    low = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return low.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
