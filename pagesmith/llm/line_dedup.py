"""Corpus-wide line de-duplication by an exact set-similarity join.

A line is the set of its words.  It is removed when an earlier line (order: id, text hash, line number; equal
lines count once, at their first place) is equal or has Jaccard similarity of at least the threshold.

Equal lines meet by hash.  For the rest, words are ordered from rare to frequent and only a prefix of
each line is indexed: two similar sets must share a word of their prefixes, at positions and with sizes that
still allow the overlap (prefix, positional and length filter).  Candidates are verified on the words.

A 64-bit parity sketch of each set drops most other candidates (every word in which two sets differ flips one
bit, so sets that differ in few words have sketches that do).  The rest is verified on the words.

Only the *existence* of an earlier match matters.  Words of at most ``COLD`` occurrences in the corpus have
buckets of bounded length, which are joined with themselves.  Other words are frequent in any large corpus, so one of
them says little: lines meet in buckets of two.  The prefix longer by one word holds the two rarest common words, so a
line is indexed under the pairs of a frequent word of its prefix and a later word of the longer one.  Such a bucket is
only long where many lines are alike, and never gives all its pairs: in one sorted pass every line meets the first and
the last few earlier lines of its bucket, and only lines without a match so far meet the whole bucket.  Of a line's
candidates the one with the nearest sketch is verified first, the others only if that fails.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesmith.llm.common import BROADCAST_ROWS, drop, free_name, sized, stripped, table, words

THRESHOLD = Fraction(4, 5)
#: Words share so many hash slots; a slot has the size class of its most frequent word, which orders its words.
SLOTS = 1 << 20
#: Size class of a slot whose words occur once in the corpus: no other line holds such a word, so it is not indexed.
ONCE = 2
#: Size class of words with bounded buckets: up to 2 ** (COLD / 2) occurrences.
COLD = 18
#: Distinct words up to which lines meet by two frequent words; the pairs of a longer line would be too many, and it
#: meets the lines of its size by one.
LONG = 256
#: Earlier lines of a long bucket that each line meets in the sorted pass, besides the first.
LAGS = 3
#: Removed line numbers up to which they are broadcast to the texts (8 bytes each at most).
BROADCAST_NUMBERS = 4_000_000
LINE = ["h1", "h2"]
#: Parity sketch of eight longs over the hashed words ``w`` (nine bits of a hash name its bit).
WIDE_SKETCH = ("transform(sequence(0, 7), k -> aggregate(filter(w, h -> (shiftrightunsigned(h, 20) & 7) = k), 0L, "
               "(s, h) -> s ^ shiftleft(1L, cast(h & 63 as int))))")


def text_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells documents of equal id apart, and orders them: the text's hash.  It is 0 where no id has several
    texts: ids are enough there, and a constant takes no room in the narrow rows."""
    th = F.xxhash64(F.col(text_col))
    several = docs.groupBy(F.col(id_col)).agg((F.min(th) != F.max(th)).alias("several")).agg(F.max("several")).first()[0]
    return th if several else F.lit(0).cast("long")


def _hashes() -> list[Column]:
    """The columns ``LINE`` of a line."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2")]


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """(id, th, pos, line, h1, h2) of the lines that hold a word; pos counts all lines from 0; th is ``key``, the
    text's hash by default."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    th = F.xxhash64(F.col(text_col)) if key is None else key
    return (docs.select(F.col(id_col).alias("id"), th.alias("th"), F.posexplode_outer(F.split(text, "\n")).alias("pos", "line"))
            .where(stripped(F.col("line")) != "")
            .select("id", "th", "pos", "line", *_hashes()))


def rarity(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row with an array of bytes: size class (twice the binary logarithm) of the most frequent word of every hash slot.

    Words are counted exactly over the whole corpus, and a slot takes the greatest count, not the sum: in a corpus of any
    size a rare word is only taken for a frequent one if it shares the slot of one.  The length is fixed, whatever
    the vocabulary."""
    words_ = docs.select(F.explode_outer(words(F.col(text_col))).alias("w")).where("w is not null").select(F.xxhash64("w").alias("w"))
    counts = words_.groupBy("w").agg(F.count("*").alias("n"))
    by_slot = counts.groupBy(F.col("w").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")).agg(F.max("n").alias("n"))
    packed = by_slot.select((F.col("slot") * 256 + F.floor(2 * F.log2(F.col("n") + 1)).cast("int")).alias("x"))
    packed = packed.unionByName(docs.sparkSession.range(0, SLOTS, 1, 1).select((F.col("id") * 256).cast("int").alias("x")))
    by_part = packed.groupBy(F.shiftright("x", 18).alias("part")).agg(F.array_sort(F.collect_list("x")).alias("xs"))  # 1024 slots, each once or twice
    last = F.expr("filter(transform(xs, (x, i) -> if(shiftright(x, 8) <=> shiftright(get(xs, i + 1), 8), null, cast(x & 255 as tinyint))), x -> x is not null)")
    by_part = by_part.select("part", last.alias("xs"))
    return by_part.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "xs"))), lambda r: r["xs"])).alias("classes"))


def _ordered(line: Column, classes: str) -> Column:
    """A line's distinct words as longs that sort from rare to frequent: size class, then hash."""
    hashes = F.array_distinct(F.transform(words(line), lambda x: F.xxhash64(x)))
    return F.sort_array(F.flatten(F.transform(F.array(classes), lambda c: F.transform(hashes, lambda h: F.shiftleft(
        F.get(c, h.bitwiseAND(F.lit(SLOTS - 1)).cast("int")).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))))))


def _may_match(t: Fraction, a: str, b: str) -> str:
    """SQL: sizes, positions of a shared word (of two: before the second) and sketches (n, i, sketch; aliases a, b) allow the overlap."""
    p, q = t.numerator, t.denominator
    return (f"({p + q} * bit_count({a}.sketch ^ {b}.sketch) <= {q - p} * ({a}.n + {b}.n) "
            f"and {q} * least({a}.n, {b}.n) >= {p} * greatest({a}.n, {b}.n) "
            f"and {p + q} * least({a}.n - {a}.i, {b}.n - {b}.i) >= {p} * ({a}.n + {b}.n))")


def _lines_at(places: DataFrame, docs: DataFrame) -> DataFrame:
    """(place, line) of the places; only the texts of their documents are split.  ``docs`` holds id, th and text."""
    at = places.select("place.*").groupBy("id", "th").agg(F.collect_list("pos").alias("at"))  # at most a document's lines
    at = F.broadcast(at) if places.count() <= BROADCAST_ROWS else at
    same = F.col("d.id").eqNullSafe(F.col("x.id")) & (F.col("d.th") == F.col("x.th"))
    split = docs.alias("d").join(at.alias("x"), same).select("d.id", "d.th", F.split("text", "\n").alias("lines"), "at")
    picked = F.transform("at", lambda i: F.struct(i.alias("pos"), F.get("lines", i).alias("line")))
    return split.select("id", "th", F.explode(picked).alias("p")).select(F.struct("id", "th", "p.pos").alias("place"), "p.line")


def _matched(pairs: DataFrame, docs: DataFrame, t: Fraction) -> DataFrame | None:
    """(place, h1, h2) of the lines ``b`` with a match among their candidates ``a`` (both are places); None
    without candidates.  Wide sketches, which still tell long lines apart, are compared first; then the words
    of the nearest candidate; then, where that fails, of the others."""
    spark, p, q = pairs.sparkSession, t.numerator, t.denominator
    pairs = table(pairs.distinct(), "lines-pairs")
    if pairs.isEmpty():
        return None
    ends = table(pairs.select(F.explode(F.array("a", "b")).alias("place")).distinct(), "lines-ends")
    texts = _lines_at(ends, docs).select("place", *_hashes(), "line", F.array_distinct(
        F.transform(words(F.col("line")), lambda x: F.xxhash64(x))).alias("w"))
    texts = table(texts.select("place", *LINE, "line", F.size("w").alias("n"), F.expr(WIDE_SKETCH).alias("wide")), "lines-texts")

    one = lambda s: texts.select(F.col("place").alias(s), F.col("n").alias(f"n{s}"), F.col("wide").alias(f"w{s}"))
    apart = F.expr("aggregate(zip_with(wa, wb, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
    near = pairs.join(one("a"), "a").join(one("b"), "b").withColumn("d", apart).where(
        (p + q) * F.col("d") <= (q - p) * (F.col("na") + F.col("nb"))).select("a", "b", "d")
    near = table(near, "lines-near")
    best = table(near.groupBy("b").agg(F.min(F.struct("d", "a")).alias("m"), F.count("*").alias("k")).select("b", "m.a", "k"), "lines-best")

    def verified(some: DataFrame) -> DataFrame:
        """Only the lines that ``some`` names are shuffled, where their places are few enough to be sent to the texts."""
        places = table(some.select(F.explode(F.array("a", "b")).alias("place")).distinct(), "lines-places")
        few = texts.join(F.broadcast(places), "place", "left_semi") if places.count() <= BROADCAST_ROWS else texts
        left = few.select(F.col("place").alias("a"), F.col("line").alias("line_a"), F.col("n").alias("na"))
        right = few.select(F.col("place").alias("b"), *LINE, F.col("line").alias("line_b"), F.col("n").alias("nb"))
        common = F.size(F.array_intersect(words(F.col("line_a")), words(F.col("line_b"))))
        out = table(some.select("a", "b").join(left, "a").join(right, "b").where((p + q) * common >= p * (F.col("na") + F.col("nb"))).select(
            F.col("b").alias("place"), *LINE).distinct(), "lines-verified")
        drop(spark, places)
        return out

    found = verified(best)
    failed = table(best.where("k > 1").join(sized(found.select(F.col("place").alias("b")).distinct()), "b", "left_anti")
                   .select("b", F.col("a").alias("tried")), "lines-failed")
    if not failed.isEmpty():
        found = table(found.unionByName(verified(near.join(sized(failed), "b").where("a <> tried"))), "lines-matched")  # no place twice
    drop(spark, pairs, ends, texts, near, best, failed)
    return found


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: Fraction = THRESHOLD, key: Column | None = None) -> DataFrame:
    """(id, th, removed): the line numbers that go, ascending, for every document (id and ``key``, the text's hash
    by default) with such lines."""
    spark, t = docs.sparkSession, Fraction(threshold)
    lines = lines_of(docs, id_col, text_col, key)
    first_here = (F.col("first.pos") == F.col("pos")) & (F.col("first.th") == F.col("th")) & F.col("first.id").eqNullSafe(F.col("id"))
    repeats = table(lines.groupBy(*LINE).agg(F.min(F.struct("id", "th", "pos")).alias("first"), F.count("*").alias("k"))
                    .where("k > 1").select(*LINE, "first"), "lines-repeats")
    distinct = lines.join(sized(repeats), LINE, "left").where(F.col("first").isNull() | first_here)

    p, q = t.numerator, t.denominator
    classes = table(rarity(docs, text_col), "lines-classes")
    # a subquery, not a constant: the plan, which the driver prints and logs again and again, doesn't hold its values.  It is
    # read where it stands (analysis wants a column of it first, the optimizer merges both selects) and is in no row.
    ordered = distinct.select("id", "th", "pos", "line", classes.scalar().alias("classes")).select(
        "id", "th", "pos", _ordered(F.col("line"), "classes").alias("w"))
    keyed = ordered.select(
        "id", "th", "pos", "w", F.size("w").alias("n"),
        F.expr("aggregate(w, 0L, (s, h) -> s ^ shiftleft(1L, cast(h & 63 as int)))").alias("sketch"))
    keyed = keyed.withColumn("least", F.expr(f"cast(ceil({p} * n / {q}) as int)"))  # common words that a match has at least
    keyed = keyed.withColumn("w", F.expr("slice(w, 1, n - least + 2)"))  # the longer prefix: each index row is made from a copy of it
    index = keyed.select("*", F.posexplode_outer(F.expr("slice(w, 1, n - least + 1)")).alias("i", "key")).where(
        F.shiftrightunsigned("key", 56) > ONCE)
    index = index.withColumn("hot", F.shiftrightunsigned("key", 56) > COLD)
    # what a word meets with: a later word of the longer prefix, or nothing (0).  Matches of a line beyond LONG have
    # over LONG * threshold words; with one common word both lines have no more to have.
    alone = f"not hot or least = 1 or {q} * n >= {p * LONG}"
    other = F.expr(f"concat(if(hot and n <= {LONG}, slice(w, i + 2, n - least + 1 - i), array()), if({alone}, array(0L), array()))")
    index = index.select("id", "th", "pos", "n", "sketch", "i", "key", "hot", F.posexplode_outer(other).alias("j", "other")).where("j is not null")
    index = index.select("id", "th", "pos", "n", "sketch", "hot",
                         F.expr("if(other = 0, i, i + j)").alias("i"),  # the second of two shared words stands at i + j + 1
                         F.expr("if(hot, xxhash64(key, other) & 1099511627775, key & 2147483647)").alias("word"))  # 40 or 31 bits name the bucket
    index = table(index, "lines-index")

    # position and size of a row share a long: fewer bytes to shuffle
    cold = index.where("not hot").select("id", "th", "word", "sketch", F.expr("shiftleft(cast(pos as bigint), 32) | i").alias("pi"), "n")
    side = lambda x: F.expr(f"struct({x}.id as id, {x}.th as th, cast(shiftright({x}.pi, 32) as int) as pos)")
    allowed = _may_match(t, "a", "b").replace("a.i", "(a.pi & 4294967295)").replace("b.i", "(b.pi & 4294967295)")
    pairs = cold.alias("a").join(cold.alias("b"), F.expr(
        f"a.word = b.word and {allowed} and struct(a.id, a.th, shiftright(a.pi, 32)) < struct(b.id, b.th, shiftright(b.pi, 32))")).select(
        side("a").alias("a"), side("b").alias("b"))

    entry, w = F.struct("id", "th", "pos", "n", "i", "sketch"), Window.partitionBy("word").orderBy("id", "th", "pos")
    met = [F.first(entry).over(w), *(F.lag(entry, k).over(w) for k in range(1, LAGS + 1))]
    # late: an earlier line of the bucket was not met; early: a later line of it did not meet this one
    seen = index.where("hot").select("*", F.array(*met).alias("met"), F.lag("n", LAGS + 1).over(w).isNotNull().alias("late"),
                                     F.lead("n", LAGS + 1).over(w).isNotNull().alias("early"))
    near = F.expr("transform(filter(met, m -> m is not null and struct(m.id, m.th, m.pos) <> struct(id, th, pos) and "
                  + _may_match(t, "m", "r") + "), m -> struct(m.id, m.th, m.pos))")
    here = F.struct("id", "th", "pos")
    seen = table(seen.alias("r").select("id", "th", "pos", "n", "i", "sketch", "word", "late", "early", near.alias("near"))
                 .where("late or early or size(near) > 0"), "lines-long")
    met_pairs = seen.select(F.explode("near").alias("a"), here.alias("b"))
    texts = docs.select(F.col(id_col).alias("id"), (F.xxhash64(F.col(text_col)) if key is None else key).alias("th"), F.col(text_col).alias("text"))
    found = _matched(pairs.unionByName(met_pairs), texts, t)

    columns = ["word", "id", "th", "pos", "n", "i", "sketch"]
    left = seen.where("late").withColumn("place", here)
    if found is not None:
        left = left.join(sized(found.select("place").distinct()), "place", "left_anti")
    rest = left.select(columns).alias("b").join(seen.where("early").select(columns).alias("a"), F.expr(
        f"a.word = b.word and {_may_match(t, 'a', 'b')} and struct(a.id, a.th, a.pos) < struct(b.id, b.th, b.pos)"))
    more = _matched(rest.select(F.struct("a.id", "a.th", "a.pos").alias("a"), F.struct("b.id", "b.th", "b.pos").alias("b")), texts, t)
    matched = spark.createDataFrame([], "h1 bigint, h2 bigint")
    for x in (found, more):
        matched = matched if x is None else matched.unionByName(x.select(*LINE))
    matched = matched.distinct().withColumn("gone", F.lit(True))

    hits = table(repeats.join(matched, LINE, "full").select(*LINE, "first", "gone"), "lines-hits")
    away = lines.drop("line").join(sized(hits), LINE).where(F.col("gone").isNotNull() | ~first_here)
    out = table(away.groupBy("id", "th").agg(F.sort_array(F.collect_set("pos")).alias("removed")), "lines-removed")
    drop(spark, classes, index, seen, found, more, repeats, hits)
    return out.withColumnRenamed("id", id_col)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: Fraction = THRESHOLD,
                removed_out: str | None = None) -> DataFrame:
    """``docs`` with the text of the lines that stay, in order; ``removed_out`` names an optional column for
    the line numbers that went.

    * Lines without a word are never duplicates and stay; a null text stays null.
    * Rows with equal id and text are one document and lose the same lines.  Rows with an equal (or null) id and
      different texts are documents of their own, in the order of the texts' hashes (xxHash64).  A null id comes
      first in the order.
    * Extra columns are kept; an empty table gives an empty one.
    """
    gone = free_name(docs, "removed")
    lines = free_name(docs, "lines")
    key = text_key(docs, id_col, text_col)
    th = free_name(docs, "text_hash")
    dup = duplicate_lines(docs, id_col, text_col, threshold, key).select(F.col(id_col).alias("id"), "th", F.col("removed").alias(gone))
    numbers = dup.agg(F.sum(F.size(gone) + 4)).first()[0] or 0
    dup = (F.broadcast(dup) if numbers <= BROADCAST_NUMBERS else dup).alias("x")
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("x.id")) & (F.col(f"d.`{th}`") == F.col("x.th"))
    d = docs.withColumn(th, key).alias("d").join(dup, same, "left").drop(F.col("x.id"), F.col("x.th"))
    d = d.withColumn(lines, F.when(F.col(gone).isNotNull(), F.split(text_col, "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    cols = [F.when(F.col(gone).isNull(), F.col(f"`{c}`")).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`")
            for c in docs.columns]
    return d.select(*cols, *([F.col(gone).alias(removed_out)] if removed_out else []))
