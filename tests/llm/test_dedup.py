"""SimHash classes, line duplicates and components against brute force, and their edge cases."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from pagesmith.llm import line_dedup, simhash_dedup
from pagesmith.llm.components import connected_components


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_chains_cycles_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 70), (70, 50), (50, 50)] + [(100, i) for i in range(101, 130)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges + [(None, 3), (7, None), (2, 1)], "a long, b long")).collect()}
    want = brute_components({n for e in edges for n in e}, edges)
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_at_up_to_four_bits_are_all_found(spark):
    rng = random.Random(3)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, 6)):
                f ^= 1 << b
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {r.fp: r.comp for r in simhash_dedup.link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = brute_components(signed, [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4])
    assert got == want


def test_segments_leave_one_with_at_most_one_differing_bit():
    for d in range(9):
        cut = simhash_dedup.segments(d)
        assert sum(n for _, n in cut) == 64 and 2 * len(cut) > d


def test_near_duplicates_edge_cases(edge_docs, edge_rows, no_docs):
    rows = simhash_dedup.near_duplicates(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in rows) == sorted(
        (i is None, i or 0, "%016x" % brute_fingerprint(t)) for i, t in edge_rows)
    zero = {(r.doc_id, r.component_id) for r in rows if r.fingerprint == "0" * 16}
    assert zero == {(None, 1), (1, 1), (2, 1)}
    assert simhash_dedup.near_duplicates(no_docs).count() == 0


def test_keep_one_of_each_class(edge_docs, edge_rows, no_docs):
    kept = simhash_dedup.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    classes = {r["class"] for r in simhash_dedup.near_duplicates(edge_docs).collect()}
    assert len(ids) == len(classes) and ids.count(3) == 1 and None not in ids
    assert simhash_dedup.keep_one(no_docs).count() == 0


def brute_lines(rows, p=4, q=5):
    kept, seen, out = [], {}, {}
    for i, text in sorted(rows):
        gone = []
        for pos, line in enumerate((text or "").split("\n")):
            words = frozenset(line.encode().split())
            if not words:
                continue
            if line in seen:
                if seen[line] != (i, pos):
                    gone.append(pos)
                continue
            hit = any((p + q) * len(words & k) >= p * (len(words) + len(k)) for k in kept)
            seen[line] = None if hit else (i, pos)
            kept.append(words)
            if hit:
                gone.append(pos)
        out[i] = gone
    return out


@pytest.mark.parametrize("cold", [line_dedup.COLD, 6, -1])
def test_lines_equal_brute_force(spark, monkeypatch, cold):
    """Also with few or no words of bounded buckets, so that the sorted pass and the rest of long buckets do the work."""
    monkeypatch.setattr(line_dedup, "COLD", cold)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 30
    lines = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 30))) for _ in range(150)]

    def edit(line):
        words = line.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        return " ".join(words)
    rows = [(i, "\n".join(edit(rng.choice(lines)) for _ in range(rng.randint(1, 8)))) for i in range(200)]
    rows += [(1000 + i, edit(lines[0]) + f" extra{i % 40}") for i in range(120)]  # one large group
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows)
    got = {r.doc_id: r for r in line_dedup.deduplicate(df, removed_out="removed").collect()}
    assert {i: r.removed or [] for i, r in got.items()} == want
    for i, text in rows:
        assert got[i].text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in want[i])


def test_lines_that_share_one_frequent_word_do_not_meet(spark, monkeypatch):
    """Frequent words alone gave buckets that every line without a match had to meet whole."""
    monkeypatch.setattr(line_dedup, "COLD", 6)
    rng, table, late = random.Random(3), line_dedup.table, []

    def counted(df, name):
        out = table(df, name)
        if name == "lines-long":
            late.append(out.where("late").count())
        return out
    monkeypatch.setattr(line_dedup, "table", counted)
    rows = [(i, " ".join(f"w{k}" for k in rng.sample(range(400), 12))) for i in range(1500)]
    rows += [(2000 + i, rows[i][1] + " more") for i in range(0, 1500, 100)]
    got = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), removed_out="removed").collect()
    assert {r.doc_id: r.removed or [] for r in got} == brute_lines(rows)
    assert late[0] < len(rows) / 10


@pytest.mark.parametrize("long", [3, 10, 20])
def test_lines_around_the_size_limit_of_pairs(spark, monkeypatch, long):
    """Lines on both sides of LONG, and of one word, still find each other where all words are frequent."""
    monkeypatch.setattr(line_dedup, "COLD", -1)
    monkeypatch.setattr(line_dedup, "LONG", long)
    rng = random.Random(11)
    lines = [rng.sample(range(60), rng.randint(1, 26)) for _ in range(50)]

    def edit(line):
        words = [x for x in line if rng.random() > 0.06] + [100 + rng.randrange(9) for _ in range(rng.randint(0, 2))]
        rng.shuffle(words)
        return " ".join(f"w{x}" for x in words or line) + rng.choice(["", " ", "  "])
    rows = [(i, "\n".join(edit(rng.choice(lines)) for _ in range(3))) for i in range(150)]
    got = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), removed_out="removed").collect()
    assert {r.doc_id: r.removed or [] for r in got} == brute_lines(rows)


@pytest.mark.parametrize("cold", [line_dedup.COLD, -1])
def test_rows_of_equal_and_null_ids_lose_only_their_own_lines(spark, monkeypatch, cold):
    """Texts under one id are documents of their own, in the order id, text hash, line number."""
    monkeypatch.setattr(line_dedup, "COLD", cold)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(60)]

    def edit(line):
        return line + rng.choice(["", "", " more", f" x{rng.randrange(9)}"])
    rows = [(rng.choice([None, None, 1, 2, 3]), "\n".join(edit(rng.choice(lines)) for _ in range(rng.randint(1, 6)))) for _ in range(80)]
    rows += [(None, "only here one two three\nshared line of the first row"), (None, "shared line of the first row\nonly there four five six"),
             (7, "equal place in both rows\nfirst of its own"), (7, "equal place in both rows\nsecond of its own"), (7, None), (None, None)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.lit("clash")).withColumn("th", F.lit("clash"))
    keyed = {(r.doc_id, r.text): r.k for r in df.select("doc_id", "text", F.xxhash64("text").alias("k")).collect()}
    order = sorted(keyed, key=lambda x: (x[0] is not None, x[0] or 0, keyed[x]))
    want = brute_lines([(place, text or "") for place, (_, text) in enumerate(order)])
    got = line_dedup.deduplicate(df, removed_out="gone").select("doc_id", "text", "gone").collect()

    def kept(i, text):
        gone = want[order.index((i, text))]
        return text and "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone), gone
    key = lambda x: str((x[0] or -1, x[1], x[2]))
    assert sorted(((r.doc_id, r.text, r.gone or []) for r in got), key=key) == sorted(((i, *kept(i, t)) for i, t in rows), key=key)


def test_lines_edge_cases(edge_docs, edge_rows, no_docs):
    out = line_dedup.deduplicate(edge_docs)
    assert out.columns == edge_docs.columns
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in out.collect()), key=str)
    from tests.llm.conftest import PROSE
    # the null id comes first in the order, so its prose is the first and every later equal line goes
    assert sorted(rows, key=str) == sorted([
        (True, 0, None), (True, 0, PROSE), (False, 1, ""), (False, 2, " \t\n "), (False, 3, ""), (False, 3, ""), (False, 4, ""),
        (False, 5, "x"), (False, 6, ""), (False, 7, "\n\n" + PROSE.upper() + "\n"), (False, 8, "123 456 +++ ###")], key=str)
    assert line_dedup.deduplicate(no_docs).count() == 0


def test_shuffled_join_gives_the_same_as_broadcast(spark, monkeypatch):
    import pagesmith.llm.common as common
    rows = [(i, f"alpha beta gamma delta epsilon {i % 3}\nzeta eta theta {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = {tuple(r) for r in line_dedup.deduplicate(df).collect()}
    monkeypatch.setattr(line_dedup, "sized", lambda x, rows=0: x)
    monkeypatch.setattr(line_dedup, "BROADCAST_NUMBERS", -1)
    assert {tuple(r) for r in line_dedup.deduplicate(df).collect()} == first
    assert common.free_name(df, "TEXT") == "TEXT_"
    assert df.agg(F.count("*")).first()[0] == 30


def test_plans_do_not_hold_the_size_classes(spark, monkeypatch):
    """As a constant in the plan they went through the driver's memory with every text of the plan."""
    rows = [(i, f"alpha beta gamma delta epsilon {i % 3}\nzeta eta theta w{i}") for i in range(30)]
    table, plans = line_dedup.table, {}

    def planned(df, name):
        out = table(df, name)
        plans[name] = df._jdf.queryExecution().toString()
        return out
    monkeypatch.setattr(line_dedup, "table", planned)
    line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert max(map(len, plans.values())) < 200_000
    physical = plans["lines-index"].split("== Physical Plan ==")[1]
    assert "Subquery" in physical and " AS classes#" not in physical  # no row carries the array


def test_words_that_occur_once_are_not_indexed(spark, monkeypatch):
    rows = [(i, f"common words of all lines here u{i} v{i}\nonly{i} once{i} in{i} the{i} corpus{i}") for i in range(40)]
    table, kept = line_dedup.table, {}

    def counted(df, name):
        out = table(df, name)
        if name == "lines-index":
            kept["lines"] = {(r.id, r.pos) for r in out.select("id", "pos").collect()}
        return out
    monkeypatch.setattr(line_dedup, "table", counted)
    got = line_dedup.deduplicate(spark.createDataFrame(rows + [(99, rows[7][1].split("\n")[0] + " more")], "doc_id long, text string"),
                                 removed_out="removed").collect()
    assert kept["lines"] == {(7, 0), (99, 0)}
    assert {r.doc_id: r.removed or [] for r in got} == brute_lines(rows + [(99, rows[7][1].split("\n")[0] + " more")])
