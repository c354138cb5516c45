"""language identification (character-trigram naive Bayes) with integer weights.

Training (``train_profile``) takes a table (lang, text) and counts lower-cased character trigrams per
language, one row per (trigram, language).  With add-one smoothing over the vocabulary V (distinct trigrams
of all languages) and T_l trigrams of language l, the weight of a trigram is the integer
``round(1000 * ln((c + 1) / (T_l + V)))`` - integers make the score sum exact and order-free.  The profile
keeps the difference to the language's unseen weight, so unseen trigrams need no rows.  Languages are
numbered; their names are values only, never column names, and there may be any number of them.

Scoring (``detect_language``) is local to a row when the profile is small by its measured bytes: the profile is
broadcast and an Arrow UDF reads the title alone.  Beyond that limit the distinct titles are scored by a
shuffle join and joined back.  Both give the same answer.  A tie for the best score, NULL text, text without
letters, or text shorter than three characters gives NULL.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.session import scratch_path

BROADCAST_BYTES = 64 << 20
#: Bytes of a profile entry in memory, about: a trigram, a language number and a weight.
ENTRY_BYTES = 100


def trigrams(text: Column) -> Column:
    """All overlapping character (code point) trigrams of lower(text), with repeats, as a
    multiset (order is not kept); [] if shorter than three characters.

    Three non-overlapping passes of ``(...)`` starting at offsets 0, 1 and 2 together give every
    overlapping trigram exactly once; regex matching advances by whole code points, so characters
    above U+FFFF are handled like any other."""
    low = F.lower(text)
    return F.concat(*[F.regexp_extract_all(F.substring(low, k + 1, 2147483647), F.lit("(?s)(...)"), 1)
                      for k in range(3)])


@dataclass
class LanguageProfile:
    table: DataFrame        # gram, lang_no, d: weight minus the language's unseen weight
    langs: list[str]        # by number
    unseen: list[int]       # unseen-trigram weight per language
    entries: int            # rows of ``table``


def train_profile(training: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageProfile:
    """One pass over the texts (counts per trigram and language, written once to the shared folder), then
    aggregates over those counts.  ``ln`` is always evaluated by Spark, so seen and unseen weights use the
    same arithmetic.  Languages whose texts give no trigram are no candidates."""
    spark = training.sparkSession
    path = scratch_path(spark, "language-counts")
    grams = training.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.explode_outer(trigrams(F.col(text_col))).alias("gram")).where("gram is not null")
    grams.groupBy("lang", "gram").agg(F.count("*").alias("c")).write.parquet(path)
    counts = spark.read.parquet(path)
    vocab = counts.select("gram").distinct().count()
    weight = lambda c, t: F.round(1000.0 * F.ln(c.cast("double") / (t + F.lit(vocab)).cast("double"))).cast("bigint")
    totals = counts.groupBy("lang").agg(F.sum("c").alias("t"), F.count("*").alias("n")).select(
        "lang", "t", "n", weight(F.lit(1), F.col("t")).alias("u")).orderBy("lang").collect()
    names = spark.createDataFrame([(r["lang"], k, r["t"], r["u"]) for k, r in enumerate(totals)],
                                  "lang string, lang_no int, t bigint, u bigint")
    table = counts.join(F.broadcast(names), "lang").select(
        "gram", "lang_no", (weight(F.col("c") + 1, F.col("t")) - F.col("u")).alias("d"))
    return LanguageProfile(table, [r["lang"] for r in totals], [r["u"] for r in totals], sum(r["n"] for r in totals))


def _best(scores: np.ndarray) -> int | None:
    """Place of the only best score, None on a tie."""
    k = int(scores.argmax())
    return k if (scores == scores[k]).sum() == 1 else None


def _score_rows(text: Column, profile: LanguageProfile) -> Column:
    """Language of each text by a UDF over the broadcast profile."""
    weights: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for r in profile.table.groupBy("gram").agg(F.collect_list(F.struct("lang_no", "d")).alias("w")).collect():
        weights[r["gram"]] = (np.array([x["lang_no"] for x in r["w"]]), np.array([x["d"] for x in r["w"]], np.int64))
    shared = profile.table.sparkSession.sparkContext.broadcast((weights, profile.langs, np.array(profile.unseen, np.int64)))

    @F.pandas_udf("string")
    def language(texts: pd.Series, lowered: pd.Series) -> pd.Series:
        known, langs, unseen = shared.value
        out = []
        for t, low in zip(texts, lowered):
            n = len(low) - 2 if low is not None else 0
            if n < 1 or not langs or not any(map(str.isalpha, t)):
                out.append(None)
                continue
            scores = n * unseen
            for gram, k in Counter(low[i:i + 3] for i in range(n)).items():
                hit = known.get(gram)
                if hit is not None:
                    scores[hit[0]] += k * hit[1]
            best = _best(scores)
            out.append(None if best is None else langs[best])
        return pd.Series(out, dtype=object)

    return language(text, F.lower(text))


def _score_by_join(texts: DataFrame, profile: LanguageProfile) -> DataFrame:
    """(text, language) for distinct non-null texts with a best language, by shuffle joins."""
    text = F.col("text")
    grams = texts.where(text.rlike("\\p{L}")).select("text", F.explode_outer(trigrams(text)).alias("gram")).where("gram is not null")
    counted = grams.groupBy("text", "gram").agg(F.count("*").alias("k"))
    sizes = counted.groupBy("text").agg(F.sum("k").alias("n"))
    hits = counted.join(profile.table, "gram").groupBy("text", "lang_no").agg(F.sum(F.col("k") * F.col("d")).alias("s"))
    spark = profile.table.sparkSession
    langs = spark.createDataFrame(list(enumerate(profile.unseen)), "lang_no int, u bigint")
    every = sizes.select("text", "n", F.explode(F.sequence(F.lit(0), F.lit(len(profile.langs) - 1))).alias("lang_no"))
    scores = every.join(langs, "lang_no").join(hits, ["text", "lang_no"], "left").select(
        "text", "lang_no", (F.col("n") * F.col("u") + F.coalesce("s", F.lit(0))).alias("score"))
    top = scores.groupBy("text").agg(F.max("score").alias("score"))
    names = spark.createDataFrame(list(enumerate(profile.langs)), "lang_no int, language string")
    return (scores.join(top, ["text", "score"]).groupBy("text").agg(F.min("lang_no").alias("lang_no"), F.count("*").alias("n"))
            .where("n = 1").join(names, "lang_no").select("text", "language"))


def detect_language(df: DataFrame, profile: LanguageProfile, text_col: str = "title", out_col: str = "language",
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with ``out_col`` (a training ``lang`` value or NULL), replacing a column of that name.  Needs no
    row key.  Only ``text_col`` is read for scoring; with a profile of up to ``broadcast_bytes`` nothing is
    shuffled."""
    out = df.drop(out_col) if out_col in df.columns else df
    if profile.entries * ENTRY_BYTES <= broadcast_bytes:
        return df.select(*[F.col(f"`{c}`") for c in out.columns], _score_rows(F.col(text_col), profile).alias(out_col))
    found = _score_by_join(df.select(F.col(text_col).alias("text")).where("text is not null").distinct(), profile)
    found = found.select(F.col("text").alias("_text"), F.col("language").alias(out_col))
    return out.join(found, F.col(text_col) == F.col("_text"), "left").drop("_text")
