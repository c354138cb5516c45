"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a few differing bits.

Fingerprinting is a vectorised Arrow UDF (each text whole, in blocks of shingles, so memory stays
bounded).  Linking is plain DataFrame work on *distinct* fingerprints.  With radius d the 64 bits are
cut into d // 2 + 1 segments, so two fingerprints within d bits have a segment that differs in at most one bit.
Each segment is indexed once per bit with that bit as a wildcard; an equality join on (bit, rest of
the segment) meets every such pair and the Hamming distance is verified inside the join.

Groups of thousands of near copies would give all their pairs.  Only connectivity is wanted, so
buckets are first chained (each fingerprint against the first and the previous ones of its bucket,
one sorted pass), components of those links are formed, and the exact join then compares only
fingerprints of different components, leaving out pairs inside a bucket's largest component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesmith.llm.common import drop, free_name, table
from pagesmith.llm.components import connected_components
from pagesmith.session import bounded_batches

SEED = 42
BLOCK = 1 << 15
#: Rows of a bucket that each row is chained to, besides the first.
CHAIN = 2


def simhash_text(text: str | None, shingle: int) -> int:
    """Fingerprint of one whole text as a signed 64-bit integer (0 without words)."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    lo, hi = starts[:n].tolist(), ends[-n:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(lo[k:k + BLOCK], hi[k:k + BLOCK])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little", signed=True)


def simhash(text: Column, shingle: int = 4) -> Column:
    """Column of fingerprints; null, empty and blank texts give 0."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash_text(t, shingle) for t in texts], dtype="int64")

    return fingerprint(text)


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments for a radius: one of them differs in at most one bit."""
    k = distance // 2 + 1
    cuts = [64 * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _index(df: DataFrame, distance: int) -> DataFrame:
    """The rows of ``df`` once per wildcard bit, with (bit, rest): the fingerprint's segment
    without that bit."""
    out = []
    for lo, n in segments(distance):
        segment = ((1 << n) - 1) << lo
        for w in range(lo, lo + n):
            rest = F.col("fp").bitwiseAND(F.lit(_signed(segment & ~(1 << w))))
            out.append(F.struct(F.lit(w).alias("bit"), rest.alias("rest")))
    return df.select("*", F.explode(F.array(*out)).alias("e")).select(*df.columns, "e.bit", "e.rest")


def link_fingerprints(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, comp) for every distinct non-null fingerprint of column ``fp``: comp names the class of
    fingerprints connected by links of at most ``distance`` differing bits."""
    spark = fps.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # each fingerprint becomes 64 index rows
    fps = table(fps.select("fp").where("fp is not null").distinct(), "simhash-fps")

    w = Window.partitionBy("bit", "rest").orderBy("fp")
    met = [F.first("fp").over(w), *(F.lag("fp", i).over(w) for i in range(1, CHAIN + 1))]
    chained = _index(fps.repartition(parts), distance).select("fp", F.array(*met).alias("met"))
    near = lambda m: (m != F.col("fp")) & (F.bit_count(m.bitwiseXOR(F.col("fp"))) <= distance)
    chained = chained.select("fp", F.explode(F.array_distinct(F.filter("met", near))).alias("m")).distinct()
    linked = connected_components(chained, "fp", "m").withColumnRenamed("node", "fp")
    comp1 = table(fps.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("c")), "simhash-comp")

    # buckets with more than one component, each row with its bucket's largest one
    bucket = ["bit", "rest"]
    b, bc = Window.partitionBy(*bucket), Window.partitionBy(*bucket, "c")
    mixed = (_index(comp1.repartition(parts), distance).withColumn("lo", F.min("c").over(b)).withColumn("hi", F.max("c").over(b))
             .where("lo <> hi").drop("lo", "hi"))
    live = table(mixed.withColumn("n", F.count("*").over(bc)).withColumn("main", F.max_by("c", F.struct("n", "c")).over(b))
                 .drop("n"), "simhash-live")
    left = live.where("c <> main").select(*bucket, F.col("fp").alias("fp1"), F.col("c").alias("c1"))
    # an equal segment shares all its wildcards: count such a pair at the segment's first bit only
    firsts = ", ".join(str(lo) for lo, _ in segments(distance))
    links = (left.alias("l").join(live.alias("r"), F.expr(
        f"l.bit = r.bit and l.rest = r.rest and c1 <> c and (c = main or fp1 < fp) "
        f"and bit_count(fp1 ^ fp) <= {int(distance)} "
        f"and (l.bit in ({firsts}) or (shiftrightunsigned(fp1 ^ fp, l.bit) & 1) = 1)"))
        .select("c1", F.col("c").alias("c2")).distinct())
    joined = connected_components(links, "c1", "c2").withColumnRenamed("node", "c")
    out = table(comp1.join(joined, "c", "left").select("fp", F.coalesce("component", "c").alias("comp")), "simhash-class")
    drop(spark, comp1, fps, live)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of ``docs``: (id, fingerprint, component_id, class, text_hash).

    * ``component_id``: smallest id whose fingerprint is reachable over links of at most
      ``distance`` differing bits.  Null ids are never that smallest id (null if a class has no id).
    * Texts that are null, empty or blank have fingerprint 0 and link like any other.
    * Repeated rows give repeated result rows; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    with bounded_batches(spark):  # a batch by rows alone is a task's whole share of the texts
        d = table(d.select("id", simhash(F.col("t"), shingle).alias("fp"), F.xxhash64("t").alias("text_hash")), "simhash-docs")
    comps = link_fingerprints(d, distance)
    low = d.groupBy("fp").agg(F.min("id").alias("low"))
    classes = comps.join(low, "fp")
    named = (classes.join(classes.groupBy("comp").agg(F.min("low").alias("component_id")), "comp")
             .select("fp", "comp", "component_id"))
    return d.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("comp").alias("class"), "text_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the one with the smallest id (null ids
    last), then the smallest text hash; identical repeats of that row count as one."""
    r = near_duplicates(docs, id_col, text_col, shingle, distance)
    key = F.struct(F.col(id_col).isNull().alias("nil"), F.col(id_col).alias("id"), F.col("text_hash").alias("th"))
    best = r.groupBy("class").agg(F.min(key).alias("k")).select("k.id", "k.th").alias("best")
    th = free_name(docs, "text_hash")
    d = docs.withColumn(th, F.xxhash64(text_col)).alias("d")
    kept = d.join(best, F.col("best.id").eqNullSafe(F.col(f"d.`{id_col}`")) & (F.col("best.th") == F.col(f"d.`{th}`")), "left_semi")
    return kept.dropDuplicates([id_col, th]).drop(th)
