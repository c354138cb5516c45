"""The back-off language model against brute force."""

import math
import random
import re
from collections import Counter

from pagesmith.operators import backoff


def brute(training, texts, distance):
    counts = {}
    for lang, text in training:
        if lang is None or text is None:
            continue
        low = text.lower()
        for n in range(1, 6):
            counts.setdefault(lang, Counter()).update(low[i:i + n] for i in range(len(low) - n + 1))
    letters = len({g for c in counts.values() for g in c if len(g) == 1})
    out = []
    ln = lambda a, b: math.floor(abs(1000 * math.log(a / b)) + 0.5) * (1 if a >= b else -1)
    for text in texts:
        if text is None or not re.search(r"[^\W\d_]", text):
            out.append(None)
            continue
        low, found = text.lower(), []
        for lang, c in counts.items():
            total = sum(v for g, v in c.items() if len(g) == 1) + letters
            score = 0
            for i in range(len(low)):
                for n in range(min(5, i + 1), 0, -1):
                    g = low[i - n + 1:i + 1]
                    if g in c:
                        score += ln(c[g] + 1, total) if n == 1 else ln(c[g], c[g[:-1]])
                        break
                else:
                    n = 1
                    score += ln(1, total)
                score -= 916 * (min(5, i + 1) - n)
            score += 916 * sum(min(5, i + 1) - 1 for i in range(len(low)))  # the steps that every language could save
            found.append((sum(x in c for x in {x for x in low if x.isalpha()}), score, lang))
        most = max(f[0] for f in found)
        lead = sorted((f[1], f[2]) for f in found if f[0] == most)[::-1]
        ahead = len(lead) == 1 or lead[0][0] > lead[1][0] and lead[0][0] - lead[1][0] >= distance * len(low)
        out.append(lead[0][1] if ahead else None)
    return out


def test_back_off_equals_brute_force(spark):
    rng = random.Random(8)
    words = {"a": ["ana", "banana", "Nab", "bab"], "b": ["bob", "ono", "nobo", "ana"], "c": ["ççe", "bebe", "ene"]}
    training = [(lang, " ".join(rng.choices(ws, k=30))) for lang, ws in words.items() for _ in range(4)] + [(None, "zzz"), ("a", None)]
    every = [w for ws in words.values() for w in ws] + ["q", "é", "12", "!"]
    texts = [" ".join(rng.choices(every, k=rng.randint(1, 6))) for _ in range(60)] + [None, "", "123", "ana", "ana", "ç"]
    profile = backoff.train_backoff(spark.createDataFrame(training, "lang string, text string"))
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, title string")
    for distance in (0, 300, 5000):
        got = {r.k: r.language for r in backoff.detect_backoff(rows, profile, distance=distance).collect()}
        assert [got[k] for k in range(len(texts))] == brute(training, texts, distance)
    none = backoff.train_backoff(spark.createDataFrame([], "lang string, text string"))
    assert backoff.detect_backoff(rows, none).where("language is not null").count() == 0


def test_rows_per_character_stay_where_the_text_is(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "ana banana"), (2, "bob ono"), (3, "a"), (4, "ana banana"), (5, None)], "k int, title string")
    training = [("a", "ana banana nab"), ("b", "bob ono nobo")]
    profile = backoff.train_backoff(spark.createDataFrame(training, "lang string, text string"))
    out = backoff.detect_backoff(rows, profile)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in plan.splitlines() if "Exchange hashpartitioning" in p and ("pos#" in p or "gram#" in p or "run#" in p)]
    got = {r.k: r.language for r in out.collect()}
    assert [got[k] for k in range(1, 6)] == brute(training, ["ana banana", "bob ono", "a", "ana banana", None], 0)
    monkeypatch.setattr(backoff, "BROADCAST_ROWS", 0)  # weights too many to broadcast
    assert {r.k: r.language for r in backoff.detect_backoff(rows, profile).collect()} == got
    one = spark.createDataFrame([("ab\n\U0001f600",)], "t string")
    assert sorted(one.select(backoff.ends("t", 3)).first()[0]) == sorted(["a", "ab", "ab\n", "b\n\U0001f600"])
