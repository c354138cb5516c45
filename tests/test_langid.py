import math
from collections import Counter

from pyspark.sql import functions as F

from pagesmith.operators import langid

TRAIN = [("en", "the quick brown fox jumps over the lazy dog and the cat"),
         ("en", "this is the house that jack built with the"),
         ("de", "der schnelle braune fuchs springt über den faulen hund"),
         ("de", "das ist das haus vom nikolaus und der"),
         ("fr", "le renard brun rapide saute par dessus le chien paresseux"),
         ("xx", None), ("yy", "ab")]
TEXTS = ["The house of the dog", "Der Hund und das Haus", "le chien", "12 !!", "ab", None, "Ünïcödé straße",
         "the der le", "emoji 😀 and the fox"]


def grams(t):
    cs = list(t.lower())
    return ["".join(cs[i:i + 3]) for i in range(len(cs) - 2)]


def brute_force(train, texts):
    """Straight Python version of the rule: add-one smoothing, integer weights, tie -> None."""
    counts = {}
    for lang, text in train:
        if text is None or lang is None:
            continue
        counts.setdefault(lang, Counter()).update(grams(text))
    counts = {lang: c for lang, c in counts.items() if sum(c.values()) > 0}  # no trigram: not a candidate
    vocab = len(set().union(*counts.values()))
    out = []
    for t in texts:
        if t is None or not any(c.isalpha() for c in t) or len(t) < 3:
            out.append(None)
            continue
        scores = {}
        for lang, c in counts.items():
            tot = sum(c.values())
            scores[lang] = sum(round(1000 * math.log((c[g] + 1) / (tot + vocab))) for g in grams(t))
        best = max(scores.values())
        winners = [l for l, s in scores.items() if s == best]
        out.append(winners[0] if len(winners) == 1 else None)
    return out


def run(spark, **kw):
    prof = langid.train_profile(spark.createDataFrame(TRAIN, "lang string, text string"))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, title string")
    res = langid.detect_language(df, prof, "title", **kw)
    return [r.language for r in res.orderBy("id").collect()], prof


def test_matches_brute_force(spark):
    got, prof = run(spark)
    assert prof.langs == ["de", "en", "fr"]
    assert got == brute_force(TRAIN, TEXTS)
    assert got[0] == "en" and got[1] == "de" and got[3] is None and got[4] is None and got[5] is None


def test_join_path_same_result(spark):
    got, _ = run(spark, broadcast_bytes=0)
    assert got == brute_force(TRAIN, TEXTS)


def test_tie_gives_null(spark):
    prof = langid.train_profile(spark.createDataFrame([("a", "xyz"), ("b", "xyz")], "lang string, text string"))
    df = spark.createDataFrame([(1, "xyz")], "id long, title string")
    assert langid.detect_language(df, prof, "title").first().language is None


def test_without_keys_keeps_all_rows(spark):
    prof = langid.train_profile(spark.createDataFrame(TRAIN, "lang string, text string"))
    df = spark.createDataFrame([(t,) for t in TEXTS], "title string")
    out = langid.detect_language(df, prof, "title")
    assert out.count() == len(TEXTS) and out.columns == ["title", "language"]


def test_trigrams_supplementary_path(spark):
    df = spark.createDataFrame([("a😀bc",), ("abcd",), ("ab",)], "t string")
    got = [sorted(r[0]) for r in df.select(langid.trigrams(F.col("t"))).collect()]
    assert got == [sorted(grams("a😀bc")), sorted(grams("abcd")), []]


def test_any_labels_and_any_number_of_them(spark):
    odd = [("en", "abc abd"), ("EN", "xyz xyw"), ("gram", "klm kln"), ("a`b", "pqr pqs")]
    many = [(f"l{i}", f"{chr(0x4e00 + i)}{chr(0x4e01 + i)}{chr(0x4e02 + i)}{i}") for i in range(1200)]
    prof = langid.train_profile(spark.createDataFrame(odd + many, "lang string, text string"))
    assert len(prof.langs) == 1204
    df = spark.createDataFrame([(t,) for _, t in odd] + [(many[700][1],)], "title string")
    for limit in (langid.BROADCAST_BYTES, 0):
        got = {r.title: r.language for r in langid.detect_language(df, prof, "title", broadcast_bytes=limit).collect()}
        assert got == {**{t: lang for lang, t in odd}, many[700][1]: "l700"}


def test_scoring_shuffles_nothing_and_reads_the_title_only(spark):
    prof = langid.train_profile(spark.createDataFrame(TRAIN, "lang string, text string"))
    df = spark.range(10).selectExpr("id", "'the dog' as title", "'long' as abstract")
    p = langid.detect_language(df, prof, "title")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p and "ArrowEvalPython" in p
