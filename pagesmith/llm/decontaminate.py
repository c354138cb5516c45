"""Benchmark decontamination with SimHash over item-sized windows, in native expressions only.

Texts and items are sequences of five-word shingles (lower case; fewer words: the whole sequence is the
only shingle).  A window is as many consecutive shingles of a document as an item has (the whole
document if it has fewer); windows and items have a 64-bit SimHash of their shingles.

* Windows that share no shingle with an item of their size have similarity 0 to all of them, so only
  windows around a shared shingle are formed.  All of those are: none is skipped.
* Fingerprints within the radius R meet in one of R + 1 blocks of bits (pigeonhole), found by equality
  of (size, block, bits); the Hamming distance is tested inside that join.
* The surviving pairs are verified by weighted Jaccard similarity: shingles weigh as often as they occur.

Random pairs differ in 32 bits and pairs of similarity 0.8 in about 10 (standard deviation 3), so the default
radius of 18 loses hardly any pair of the required similarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesmith.llm.common import drop, free_name, sized, table, words

SHINGLE, RADIUS = 5, 18
#: Required similarity as a fraction.
SIMILAR = (4, 5)
#: Spans in all texts' lists, and four a list, up to which the lists are broadcast (tens of megabytes).
BROADCAST_SPANS = 1_000_000
LANES = 0x0001000100010001
#: The top lane is signed.
LANE_HASHES = 32_767


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Hashes (xxHash64 over the words) of all word shingles in order; empty for texts without words."""
    return _shingled(words(F.lower(text)), size)


def _shingled(w: Column, size: int) -> Column:
    n = F.greatest(F.size(w) - (size - 1), F.lit(1))
    return F.when(F.size(w) > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(w, i, size)))).otherwise(
        F.array().cast("array<bigint>"))


def with_shingles(df: DataFrame, text_col: str, out: str, size: int = SHINGLE) -> DataFrame:
    """``df`` plus the shingle hashes of a text; the words are computed once, as a column of their own."""
    w = free_name(df, "words")
    return df.withColumn(w, words(F.lower(F.col(text_col)))).withColumn(out, _shingled(F.col(w), size)).drop(w)


def with_fingerprint(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """``df`` plus the SimHash of an array of shingle hashes: a bit is set if it is in over half of them.  Four bits (16
    apart) are counted at a time, in 16-bit lanes of a long; so many hashes that a lane can't overflow (``LANE_HASHES``)
    are counted together and the lanes of all such parts are added up as longs, so an array may have any length."""
    lanes = free_name(df, "lanes")
    parts = f"sequence(0, greatest(0, cast((size(`{hashes}`) - 1) div {LANE_HASHES} as int)))"
    counted = (f"transform({parts}, p -> transform(sequence(0, 15), k -> aggregate(if(size(`{hashes}`) <= {LANE_HASHES}, `{hashes}`, "
               f"slice(`{hashes}`, p * {LANE_HASHES} + 1, {LANE_HASHES})), 0L, (a, h) -> a + (shiftrightunsigned(h, k) & {LANES}L))))")
    bits = (f"aggregate(sequence(0, 63), 0L, (a, b) -> a | if(2 * aggregate(`{lanes}`, 0L, (n, x) -> n + "
            f"(shiftrightunsigned(get(x, b % 16), b - b % 16) & 65535L)) > size(`{hashes}`), shiftleft(1L, b), 0L))")
    # never null (a join would push a null test, with the lanes in it, below this) and two uses of the lanes (one
    # would be replaced by what they are made of, once per bit)
    value = F.coalesce(F.expr(bits), F.size(lanes).cast("long"), F.lit(0).cast("long"))
    return df.withColumn(lanes, F.expr(counted)).withColumn(out, value).drop(lanes)


def _blocks(radius: int) -> list[int]:
    """Bit masks of radius + 1 blocks (as signed longs)."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _indexed(df: DataFrame, radius: int) -> DataFrame:
    parts = [F.struct(F.lit(k).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(_blocks(radius))]
    return df.select("*", F.explode(F.array(*parts)).alias("e")).select(*df.columns, "e.block", "e.bits")


def common_weight(a: Column, b: Column) -> Column:
    """Size of the intersection of two arrays as multisets."""
    shared = F.array_intersect(a, b)
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return F.when(once, F.size(shared)).otherwise(
        F.aggregate(shared, F.lit(0), lambda s, x: s + F.least(count(a, x), count(b, x))))


def bounded(spans: DataFrame) -> DataFrame:
    """``spans`` marked for broadcast if its lists are small together, however few rows hold them."""
    total = spans.agg(F.sum(F.size("spans") + 4)).first()[0] or 0
    return F.broadcast(spans) if total <= BROADCAST_SPANS else spans


def contaminations(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", radius: int = RADIUS,
                   similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(id, text_hash, item, start, similarity, windows): one row per document text and item that has a window
    of sufficient similarity; start (word position) and similarity of the best window, the first of equals.

    * Null, empty and blank texts and items match nothing.
    * Items with fewer than five words are sequences to be found as they are, in texts of any length: documents get shingles
      of as many words for each such length that occurs, and equal ones match with similarity 1 (one shingle each).
    * Texts and items of any length are taken whole; the windows around a shared shingle of a long item are many and long,
      so the work for a copy grows with the square of the item's length.
    * Rows with equal id and text are one document; null ids are allowed; other columns are not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("t"))
    own = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("t"))
    own = own.withColumn("n", F.size(words(F.lower(F.col("t"))))).where("n > 0")
    short = table(own.where(F.col("n") < SHINGLE).select("item", "n", F.xxhash64(words(F.lower(F.col("t")))).alias("h")), "decont-short")
    own = with_shingles(own.where(F.col("n") >= SHINGLE), "t", "item_hs").withColumn("m", F.size("item_hs"))
    own = table(with_fingerprint(own.select("item", "m", "item_hs"), "item_hs", "item_fp"), "decont-items")
    known = table(own.select("m", F.explode_outer("item_hs").alias("h")).distinct(), "decont-known")

    # where a document has a shingle of an item, every window of that item's size that holds it
    places = with_shingles(d, "t", "hs").select("id", "th", F.size("hs").alias("k"), F.posexplode_outer("hs").alias("p", "h")).where("h is not null")
    anchors = table(places.join(sized(known), "h").select("id", "th", "k", "m", "p").distinct(), "decont-anchors")
    w = Window.partitionBy("id", "th", "m").orderBy("p")
    last = F.greatest(F.lit(0), F.least(F.col("p"), F.col("k") - F.col("m")))
    first = F.greatest(F.lit(0), F.least(F.col("p") - F.col("m") + 1, F.col("k") - F.col("m")))
    spans = (anchors.select("id", "th", "m", first.alias("first"), last.alias("last"), F.lag(last).over(w).alias("before"))
             .select("id", "th", "m", F.greatest("first", F.coalesce(F.col("before") + 1, F.lit(0))).alias("first"), "last")
             .where("first <= last"))
    spans = table(spans.groupBy("id", "th").agg(F.collect_list(F.struct("m", "first", "last")).alias("spans")), "decont-spans")

    found = d.alias("d").join(bounded(spans).alias("s"), F.expr("d.th = s.th and d.id <=> s.id")).select(
        "d.id", "d.th", "t", "spans").dropDuplicates(["id", "th"])
    found = with_shingles(found, "t", "hs").select("id", "th", "hs", F.explode("spans").alias("s")).select(
        "id", "th", "hs", "s.m", F.explode(F.sequence("s.first", "s.last")).alias("start"))
    windows = found.select("id", "th", "m", "start", F.slice("hs", F.col("start") + 1, F.col("m")).alias("win"))
    windows = with_fingerprint(windows, "win", "fp")

    same_first = "case " + " ".join(f"when (fp ^ item_fp) & {m}L = 0 then {k}" for k, m in enumerate(_blocks(radius))) + " end"
    index = _indexed(own.withColumn("fp", F.col("item_fp")), radius).drop("fp")
    pairs = _indexed(windows, radius).alias("a").join(index.alias("b"), F.expr(
        f"a.m = b.m and a.block = b.block and a.bits = b.bits and bit_count(fp ^ item_fp) <= {radius} and a.block = {same_first}"))
    p, q = similar
    both = F.size("win") + F.size("item_hs")
    pairs = pairs.select("id", "th", "item", "start", "win", "item_hs").withColumn("common", common_weight(F.col("win"), F.col("item_hs")))
    pairs = pairs.where((p + q) * F.col("common") >= p * both).select(
        "id", "th", "item", "start", (F.col("common") / (both - F.col("common"))).alias("similarity"))
    for n in sorted(r["n"] for r in short.select("n").distinct().collect()):  # at most four lengths
        runs = with_shingles(d, "t", "hs", n).select("id", "th", F.posexplode_outer("hs").alias("start", "h")).distinct()
        exact = runs.join(sized(short.where(F.col("n") == n)), "h").select("id", "th", "item", "start", F.lit(1.0).alias("similarity"))
        pairs = pairs.unionByName(exact)
    out = table(pairs.groupBy("id", "th", "item").agg(
        F.max_by("start", F.struct("similarity", -F.col("start"))).cast("long").alias("start"),
        F.max("similarity").alias("similarity"), F.count("*").alias("windows")), "decont-found")
    drop(spark, anchors, spans, own, known, short)
    return out.select(F.col("id").alias(id_col), F.col("th").alias("text_hash"), "item", "start", "similarity", "windows")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    bad = contaminations(docs, items, id_col, text_col, **options).select(F.col(id_col).alias("id"), "text_hash").distinct()
    th = free_name(docs, "text_hash")
    d = docs.withColumn(th, F.xxhash64(F.col(text_col))).alias("d")
    match = F.col(f"d.`{th}`").eqNullSafe(F.col("x.text_hash")) & F.col(f"d.`{id_col}`").eqNullSafe(F.col("x.id"))
    return d.join(sized(table(bad, "decont-bad")).alias("x"), match, "left_anti").drop(th)
