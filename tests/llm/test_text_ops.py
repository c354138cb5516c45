"""Decontamination, URL rules, quality rules, personal data: brute force on small inputs and edge cases."""

import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from pagesmith.llm import decontaminate, pii, quality_rules, url_filter
from tests.llm.conftest import PROSE


# ---- decontamination

def hashes(text):
    words = (text or "").lower().encode().split()
    out = []
    for i in range(max(1, len(words) - 4) if words else 0):
        h = 42
        for w in words[i:i + 5]:
            h = xxhash.xxh64_intdigest(w, h)
        out.append(h)
    return out


def simhash(hs):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_leaks(docs, items, radius=decontaminate.RADIUS):
    found = {}
    for d, text in docs:
        hs = hashes(text)
        for i, item in items:
            own = hashes(item)
            if not own or not hs:
                continue
            if len((item or "").split()) < 5:  # short items: the same words anywhere
                short, w = item.lower().split(), text.lower().split()
                if any(w[k:k + len(short)] == short for k in range(len(w) - len(short) + 1)):
                    found[d, i] = 1.0
                continue
            for s in range(max(1, len(hs) - len(own) + 1)):
                win = hs[s:s + len(own)]
                common = sum((Counter(win) & Counter(own)).values())
                sim = common / (len(win) + len(own) - common)
                if sim >= 0.8 and bin(simhash(win) ^ simhash(own)).count("1") <= radius:
                    found[d, i] = max(found.get((d, i), 0), sim)
    return found


ITEMS = [(1, PROSE), (2, " ".join(f"word{i}" for i in range(30))), (3, "too short here"), (4, None), (5, ""), (6, "a b a b a b a b a b a b a b")]


def test_leaks_equal_brute_force(spark):
    w = [f"word{i}" for i in range(30)]
    docs = [(1, "Intro. " + PROSE.upper() + " and then more"), (2, " ".join(w[:12] + ["changed"] + w[13:])), (3, "x " * 50 + " ".join(w[2:])),
            (4, " ".join(w[:10])), (5, "too  short\nhere"), (6, "so too short here"), (7, "a b a b a b a b a b a b a b a b"), (8, PROSE[:60])]
    got = {(r.doc_id, r.item): r.similarity for r in decontaminate.contaminations(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")).collect()}
    want = brute_leaks(docs, ITEMS)
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}
    assert (1, 1) in got and (3, 2) in got and (5, 3) in got and (6, 3) in got and (7, 6) in got


def test_decontaminate_edge_cases(spark, edge_docs, edge_rows, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.decontaminate(edge_docs, items)
    leaked = {d for d, _ in brute_leaks([(i, t) for i, (_, t) in enumerate(edge_rows)], ITEMS)}
    assert kept.columns == edge_docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(x for i, x in enumerate(edge_rows) if i not in leaked)
    assert decontaminate.decontaminate(no_docs, items).count() == 0
    assert decontaminate.contaminations(edge_docs, items.where("false")).count() == 0


def test_few_rows_with_long_lists_are_not_broadcast(spark, monkeypatch):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    lists = spark.range(2).selectExpr("id", "transform(sequence(1, 600000), i -> struct(1 as m, i as first, i as last)) as spans")
    assert hinted(decontaminate.bounded(lists.limit(1))) and not hinted(decontaminate.bounded(lists))
    docs = spark.createDataFrame([(1, "Intro. " + PROSE), (None, PROSE + " more"), (2, "other")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    first = {tuple(r) for r in decontaminate.contaminations(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "BROADCAST_SPANS", -1)
    assert {tuple(r) for r in decontaminate.contaminations(docs, items).collect()} == first and len(first) == 2


def test_blocks_guarantee_the_radius():
    for r in (0, 4, 18, 30):
        masks = [m & (2**64 - 1) for m in decontaminate._blocks(r)]
        assert len(masks) == r + 1 and sum(bin(m).count("1") for m in masks) == 64


# ---- URL rules

RULES = [("com/", True), ("example.com/en/", False), ("www.example.com/en/", True), ("net/es/", False)]


def test_longest_rule_wins_and_aliases_carry_blocks(spark):
    canon = '<html><head><link href="{}" rel="canonical"></head></html>'
    hop = '<meta http-equiv="refresh" content="0; url={}">'
    pages = [(1, "http://example.com/en/a", ""), (2, "https://www.Example.com/en/a?x#y", ""), (3, "http://other.net/es/b", ""),
             (4, "http://plain.org/p", canon.format("http://other.net/es/b")), (5, "http://second.org/q", hop.format("http://plain.org/p")),
             (6, "http://third.org/r", hop.format("http://www.example.com/en/z")), (7, "http://third.org/r", ""), (8, None, None), (9, "mailto:x", None),
             (10, "http://fourth.org/s", canon.format("http://example.com/en/blocked")), (10, "http://fourth.org/s", hop.format("http://www.example.com/en/z")),
             (11, "http://xexample.com/en/", ""), (12, "http://example.com", None), (None, "http://rel.net/a/b", canon.format("../es/c")),
             (13, "http://rel.net/es/x", canon.format("/other"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("node", F.lit(1))
    rows = url_filter.judge_urls(df, spark.createDataFrame(RULES, "rule string, allow boolean")).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(pages)
    assert got[1] == ("example.com", "/en/a", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert got[3][2:] == ("net/es/", "block") and got[4][2:] == (None, "block") and got[5][2:] == (None, "block")
    assert got[6][2:] == (None, "allow") and got[7][2:] == (None, "allow")
    assert got[8] == ("", "", None, "allow") and got[9] == ("", "", None, "allow")
    assert got[10][2:] == (None, "allow")  # an explicit allow in the component precedes the block
    assert got[11][2:] == ("com/", "allow") and got[12] == ("example.com", "", None, "allow")
    assert got[None][3] == "allow" and got[13][2:] == ("net/es/", "block")
    assert url_filter.judge_urls(df.where("false"), spark.createDataFrame(RULES, "rule string, allow boolean")).count() == 0


# ---- quality rules

def test_repeated_window_words(spark):
    texts = ["a b c d a b c", "a a a a", "x y z", "a b", "", None, "p q r s t p q r x q r s", " ".join("abc") * 3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")

    def brute(t):
        w = (t or "").split()
        c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        return len({j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)})
    got = {r.id: r.n_repeat_words for r in quality_rules.signals(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_cascade_verdict_is_independent_of_the_order(spark, edge_docs, edge_rows, no_docs):
    m = quality_rules.signals(edge_docs)
    names = [r.name for r in quality_rules.RULES]
    first = quality_rules.cascade(m, quality_rules.RULES, names)
    last = quality_rules.cascade(m, quality_rules.RULES, names[::-1])
    rows = m.select(first.isNull().alias("a"), last.isNull().alias("b")).collect()
    assert all(r.a == r.b for r in rows) and len(rows) == len(edge_rows)
    judged = quality_rules.judge(edge_docs).collect()
    assert len(judged) == len(edge_rows) and all(r.base_failed and not r.kept for r in judged if r.n_words < 50)
    order = quality_rules.rule_order(edge_docs)
    assert sorted(x["name"] for x in order) == sorted(names) and order[0]["rejected"] >= 1
    assert quality_rules.judge(no_docs).count() == 0


# ---- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes_luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def brute_spans(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "phone" and not 8 <= len(d) <= 15
                    or kind == "card" and not (16 <= len(d) <= 19 and passes_luhn(d))):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_equal_the_patterns(spark, edge_docs, edge_rows, no_docs):
    hard = ["a@b.com%x@y.org.. 1.2.3.4.5.6.7.8 +1 (2) 3-4 567890 é\U0001f600 4111 1111 1111 1111 x@y@z.co", "300.1.1.1 4111111111111111-",
            "0001.002.003.004 a_b@c-d.e-f.g_h@i.j ++49 30 1234567", "1" * 3000 + " " + "a." * 2000 + "@x", "", None,
            "4111-1111-1111-1111 4111111111111112 bob [at] site [dot] com 5500005555555559", ("mail me@here.org now " * 50)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(hard)] + [(0, hard[0])], "doc_id long, text string")
    rows = pii.detect(df).select("doc_id", pii.as_text(F.col("base")).alias("base")).collect()
    assert len(rows) == len(hard) + 1
    assert all(r.base == brute_spans(hard[r.doc_id]) for r in rows)
    assert pii.detect(edge_docs).count() == len(edge_rows) and pii.detect(no_docs).count() == 0


def test_phone_candidates_of_any_grouping(spark):
    numbers = ["0171 1234567", "555 1234567", "5551234567", "00491711234567", "(0171)1234567", "+49 (0)171 123-45-67", "12 34", "030/123.45.67",
               "(030) 123 45 67", "123456789012345", "00123456789012345"]
    none = ["12", "1" * 18, "1" * 3000]
    texts = [f"before {x} after" for x in [*numbers, *none]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: [x.m for x in r.loose if x.kind == pii.KINDS.index("phone")] for r in pii.find_spans(df, "doc_id", "text").collect()}
    assert got == {i: [x] if x in numbers else [] for i, x in enumerate([*numbers, *none])}


def test_rare_kinds_are_trained_on_beside_a_hot_one(spark):
    assert pii.shares({"a": 10, "b": 5000, "c": 9000}, 1010) == {"a": 10, "b": 500, "c": 500}
    assert pii.shares({"a": 3, "b": 4}, 100) == {"a": 3, "b": 4} and pii.shares({}, 5) == {}
    c = (spark.range(6000).selectExpr("id", "id as th", "0 as s", "9 as e", "3 as kind", "id % 3 = 0 as y")
         .unionByName(spark.range(40).selectExpr("id", "id as th", "0 as s", "9 as e", "2 as kind", "id % 4 = 0 as y"))
         .selectExpr("*", "double(kind) as f_kind", "double(y) as f_sign"))
    x, y, weight = pii.training_sample(c, ["f_kind", "f_sign"], 400)
    assert len(y) == len(weight) == 400 and ((x[:, 0] == 2) & (y == 1)).sum() == 10 and ((x[:, 0] == 2) & (y == 0)).sum() == 30
    for kind, labelled in ((2, 1 / 4), (3, 1 / 3)):  # the weights give every kind its ratio of labels
        here = x[:, 0] == kind
        assert abs((weight * y)[here].sum() / weight[here].sum() - labelled) < 1e-9
    p = pii.gbt.fit(x, y, weight=weight).probability(x)
    assert p[y == 1].min() > 0.5 > p[y == 0].max()

    # few cards among many phone numbers: a card of another spelling is selected, however many the others are
    card = "card 4111 1111 1111 1111"
    texts = [card] * 30 + ["card 4111.1111.1111.1111"] + [f"call +49 171 {1000000 + i}" for i in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for sample in (20_000, 80):
        spans = {r.doc_id: r.spans for r in pii.detect(df, sample=sample).select("doc_id", pii.as_text(F.col("added")).alias("spans")).collect()}
        assert "card:5:24" in spans[30], sample


def test_all_candidates_train(spark):
    import numpy as np

    c = (spark.range(50_000).selectExpr("3 as kind", "id % 3 = 0 as y", "3D as f_kind", "double(id % 40) as f_n", "0D as f_none")
         .unionByName(spark.range(8).selectExpr("2 as kind", "id % 4 = 0 as y", "2D as f_kind", "100D + id as f_n", "0D as f_none")))
    for most in (50_000, 20):  # beyond that many counts bins are halved, and all candidates are still there
        x, y, weight, kinds, edges = pii.binned_candidates(c, ["f_kind", "f_n", "f_none"], total=400, most=most)
        assert len(y) <= most or most == 20
        got = {(k, label): weight[(kinds == k) & (y == label)].sum() for k in (2, 3) for label in (0, 1)}
        assert got[2, 1] == 2 and got[2, 0] == 6 and abs(got[3, 0] / got[3, 1] - 33_333 / 16_667) < 1e-9
        assert all((np.isin(x[:, j], e) | (x[:, j] == e[-1] + 1)).all() for j, e in enumerate(edges))
    assert len(pii.binned_candidates(c.where("false"), ["f_kind"])[1]) == 0
    card = "card 4111 1111 1111 1111"
    texts = [card] * 30 + ["card 4111.1111.1111.1111"] + [f"call +49 171 {1000000 + i}" for i in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.detect(df).select("doc_id", pii.as_text(F.col("added")).alias("spans")).collect()}
    assert "card:5:24" in spans[30]


def test_trees_in_sql_equal_the_trees(spark):
    import numpy as np

    from pagesmith.llm import gbt
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)).round(2)
    y = (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(float)
    model = gbt.fit(x, y, trees=15)
    assert ((model.margin(x) > 0) == y).mean() > 0.95
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    got = [r[0] for r in df.select(F.expr(model.sql(["a", "b", "c"]))).collect()]
    assert np.allclose(got, model.margin(x))
    assert gbt.fit(np.zeros((0, 3)), np.zeros(0)).probability(x[:2]).tolist() == [0.5, 0.5]


# ---- long inputs

def test_fingerprints_of_any_length(spark):
    import random
    rng = random.Random(1)
    rows = [(0, [-1] * 40_000), (1, [rng.getrandbits(48) << 16 | 0xFFFF for _ in range(70_001)]), (2, [rng.getrandbits(63) for _ in range(32_768)]),
            (3, []), (4, [5]), (5, [-1] * 32_767 + [0] * 32_766)]
    rows = [(k, [h - (1 << 64) if h >> 63 and h > 0 else h for h in hs]) for k, hs in rows]
    df = decontaminate.with_fingerprint(spark.createDataFrame(rows, "k int, hs array<bigint>"), "hs", "fp")
    want = {k: simhash([h & (2**64 - 1) for h in hs]) if hs else 0 for k, hs in rows}
    assert {r.k: r.fp & (2**64 - 1) for r in df.collect()} == want


def test_personal_data_in_one_long_text(spark):
    import time
    n = 15_000  # five numbers each; the test session has a small heap
    text = "\n".join(f"row {i} host 10.{i % 256}.0.{i % 250} id {100000 + i}" for i in range(n))
    df = spark.createDataFrame([(1, text), (2, "mail a@b.co")], "doc_id long, text string")
    t0 = time.time()
    found = {r.id: r for r in pii.find_spans(df, "doc_id", "text").collect()}
    assert time.time() - t0 < 120
    want = [(m.start(), m.end()) for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", text)]
    assert [(x.s, x.e) for x in found[1].base if x.kind == 1] == want and len(want) == n
    assert [(x.kind, x.s, x.e) for x in found[2].base] == [(0, 5, 11)]
