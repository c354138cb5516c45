"""F12 with orders 1 to 5: a back-off n-gram model in integer weights, alphabet exclusion and a least distance.

A character of a text is judged by the longest n-gram of up to ``ORDERS`` characters that ends there and that the language's
training texts hold: ``round(1000 ln(count / count of the n-gram without its last character))``, plus ``BACK_OFF`` for every
order given up.  Single characters are smoothed by one over the characters of all languages; unseen ones take the
smoothed weight of none.  Sums of integers are exact and order-free.

Only languages that lack the fewest of the text's letters take part.  The best of them is the answer if it is ahead of the
next by at least the least distance (thousandths per character); otherwise, and for texts without a letter, NULL.
Training and scoring are joins and aggregates, with no limit on the profile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.session import scratch_path

ORDERS = 5
#: round(1000 ln 0.4)
BACK_OFF = -916
#: Rows of a number per language (a hundred bytes for a few languages) up to which they are broadcast; beyond, Spark shuffles.
BROADCAST_ROWS = 1_000_000


def ends(text: Column, orders: int = ORDERS) -> Column:
    """For every character of lower(text) the run of up to ``orders`` characters that ends there; linear in the text."""
    low = F.lower(text)
    head = F.filter(F.array(*(F.when(F.length(low) >= n, F.left(low, F.lit(n))) for n in range(1, orders)), F.lit(None).cast("string")), lambda g: g.isNotNull())
    return F.concat(head, *(F.regexp_extract_all(F.substring(low, k + 1, 2147483647), F.lit(f"(?s)(.{{{orders}}})"), 1) for k in range(orders)))


@dataclass
class BackoffProfile:
    table: DataFrame    # gram, lang, d: what a hit adds to the text's sum of unseen characters
    unseen: DataFrame   # lang, u: weight of an unseen character
    back_off: int


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def train_backoff(training: DataFrame, lang_col: str = "lang", text_col: str = "text", orders: int = ORDERS, back_off: int = BACK_OFF) -> BackoffProfile:
    """Counts over whole texts; null languages and texts are left out.  Only the longest run that starts at each character is
    counted there; shorter ones are its beginnings and are counted from the distinct long ones."""
    d = training.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    low, longest = F.lower(F.col(text_col)), F.lit(f"(?s)(.{{1,{orders}}})")  # shorter at the end of a text
    starts = F.concat(*(F.regexp_extract_all(F.substring(low, k + 1, 2147483647), longest, 1) for k in range(orders)))
    found = d.select(F.col(lang_col).alias("lang"), F.explode(starts).alias("run")).groupBy("lang", "run").agg(F.count("*").alias("c"))
    runs = found.select("lang", "run", "c", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("n"))
    counts = _written(runs.groupBy("lang", F.expr("left(run, n)").alias("gram")).agg(F.sum("c").alias("c")), "backoff-counts")
    ones = counts.where(F.length("gram") == 1)
    letters = ones.select("gram").distinct().count()
    weight = lambda c, t: F.round(1000.0 * F.ln(c.cast("double") / t.cast("double"))).cast("bigint")
    totals = ones.groupBy("lang").agg((F.sum("c") + F.lit(letters)).alias("t"))  # a row per language
    unseen = _written(totals.select("lang", "t", weight(F.lit(1), F.col("t")).alias("u")), "backoff-unseen")
    first = ones.join(F.broadcast(unseen), "lang").select("gram", "lang", (weight(F.col("c") + 1, F.col("t")) - F.col("u")).alias("d"))
    before = counts.select("lang", F.col("gram").alias("head"), F.col("c").alias("all"))
    longer = counts.where(F.length("gram") > 1).withColumn("head", F.expr("left(gram, length(gram) - 1)")).join(before.hint("merge"), ["lang", "head"])
    # back-off steps not taken are what a longer hit is ahead of an unseen character
    rest = longer.join(F.broadcast(unseen), "lang").select(
        "gram", "lang", (weight(F.col("c"), F.col("all")) - F.col("u") - back_off * (F.length("gram") - 1)).alias("d"))
    return BackoffProfile(_written(first.unionByName(rest), "backoff-profile"), unseen.select("lang", "u"), back_off)


def detect_backoff(df: DataFrame, profile: BackoffProfile, text_col: str = "title", out_col: str = "language", distance: int = 0,
                   orders: int = ORDERS) -> DataFrame:
    """``df`` with ``out_col`` (a training language or NULL), replacing a column of that name.  Distinct texts are scored and
    joined back; ties are never an answer."""
    out = df.drop(out_col)
    languages = sorted((r["lang"], r["u"]) for r in profile.unseen.collect())  # a row per language
    if not languages:
        return out.withColumn(out_col, F.lit(None).cast("string"))
    names, unseen = F.array(*(F.lit(x) for x, _ in languages)), F.array(*(F.lit(u).cast("long") for _, u in languages))
    texts = df.select(F.col(text_col).alias("text")).where(F.col("text").rlike(r"\p{L}")).distinct()
    texts = _written(texts.select(F.monotonically_increasing_id().alias("id"), _key("text").alias("key"), "text"), "backoff-texts")

    # what a character adds depends on the run that ends there alone: each distinct run is looked up once
    runs = _written(texts.select(F.explode(ends(F.col("text"), orders)).alias("run")).distinct(), "backoff-runs")
    tails = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("n")).select("run", F.expr("right(run, n)").alias("gram"))
    hits = tails.join(profile.table.hint("merge"), "gram").groupBy("run", "lang").agg(F.max_by("d", F.length("gram")).alias("d"))
    by_run = _aligned(_written(hits, "backoff-hits"), "run", F.col("d").cast("int"), names)
    found = texts.select("id", F.explode(ends(F.col("text"), orders)).alias("run")).join(_sized(by_run), "run")
    letters = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L})"), 1)
    by_letter = _aligned(profile.table.where(F.length("gram") == 1), "gram", F.lit(1), names)
    seen = texts.select("id", F.explode(F.array_distinct(letters)).alias("gram")).join(_sized(by_letter), "gram")

    # a text's rows of every kind come from one task, which sums them up before they move
    n, none = F.length(F.lower("text")).cast("long"), F.lit(0).cast("long")
    base = texts.select("id", n.alias("n"), F.posexplode(unseen).alias("l", "u")).select("id", "l", "n", none.alias("known"), (F.col("n") * F.col("u")).alias("score"))
    found = found.select("id", F.posexplode("by").alias("l", "d")).where("d is not null").select("id", "l", none.alias("n"), none.alias("known"), F.col("d").cast("long").alias("score"))
    seen = seen.select("id", F.posexplode("by").alias("l", "d")).where("d is not null").select("id", "l", none.alias("n"), F.col("d").cast("long").alias("known"), none.alias("score"))
    scores = base.unionByName(found).unionByName(seen).groupBy("id", "l").agg(*(F.sum(c).alias(c) for c in ("n", "known", "score")))
    ranked = scores.groupBy("id").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("known", "score", "l")), False).alias("by"))  # a row per language
    lead = F.filter("by", lambda x: x["known"] == F.col("by")[0]["known"])
    best, second = lead[0], F.get(lead, F.lit(1))
    ahead = second.isNull() | ((best["score"] > second["score"]) & (best["score"] - second["score"] >= distance * F.col("n")))
    picked = ranked.where(ahead).select("id", F.get(names, best["l"]).alias(out_col))
    picked = texts.select("id", F.col("key").alias("key_")).join(picked, "id").drop("id")
    return out.join(picked, _key(text_col) == F.col("key_"), "left").drop("key_")


def _aligned(df: DataFrame, key: str, value: Column, names: Column) -> DataFrame:
    """(key, by): a row per key with a number for every language in the order of ``names``, null where it has none."""
    by = F.map_from_entries(F.collect_list(F.struct("lang", value.cast("int").alias("v"))))  # a row per language
    return _written(df.groupBy(key).agg(by.alias("m")).select(key, F.transform(names, lambda x: F.get(F.map_values(F.map_filter("m", lambda k, v: k == x)), F.lit(0))).alias("by")), "backoff-aligned")


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")


def _key(c: str) -> Column:
    """A text's place in joins: its MD5, so rows per character don't carry the text."""
    return F.unhex(F.md5(F.col(c)))
