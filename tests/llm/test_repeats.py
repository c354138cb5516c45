"""Repeated passages against brute force, and their edge cases."""

import hashlib
import random

import numpy as np
import pytest

from pagesmith.llm import repeats


def order(doc_id, start):
    return (doc_id is not None, doc_id or 0), start


def brute_repeats(docs, window):
    words = [(t or "").encode().split() for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words):
        for s in range(len(w) - window + 1):
            run = tuple(w[s:s + window])
            first[run] = min(first.get(run, order(d, s)), order(d, s))
    out = []
    for (d, _), w in zip(docs, words):
        off = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < order(d, s):
                off[s:s + window] = [True] * window
        kept = b" ".join(x for x, o in zip(w, off) if not o)
        out.append((d, len(w), sum(off), kept.decode(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("window, phrase, block_bytes", [(20, 6, 1 << 22), (7, 3, 400), (5, 2, 1), (20, 6, 300)])
def test_equals_brute_force(spark, window, phrase, block_bytes):
    rng = random.Random(window + block_bytes)
    vocab, docs = [f"w{i}" for i in range(6)], []
    for i in range(120):
        w = rng.choices(vocab, k=rng.randint(0, 60))
        if docs and rng.random() < 0.6:  # a part of an earlier text, with some words changed
            w = (rng.choice(docs)[1] or "").split()
            for _ in range(rng.randint(0, 3) if w else 0):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            a = rng.randint(0, len(w))
            w = w[a:a + rng.randint(0, 60)] + rng.choices(vocab, k=rng.randint(0, 10))
        docs.append((rng.choice([None, i, i, i, i // 2]), rng.choice([" ", "\n"]).join(w)))
    docs += docs[:5]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(repeats.remove_repeats(df, window=window, phrase=phrase, block_bytes=block_bytes)) == brute_repeats(docs, window)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    passage = " ".join(f"p{i}" for i in range(60))
    long_text = " ".join(f"x{i % 997}" for i in range(200_000))
    more = [(20, "intro " + passage), (21, passage + " tail"), (22, long_text), (23, "one " * 100)]
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = repeats.remove_repeats(docs, block_bytes=1000)
    assert rows(got) == brute_repeats(edge_rows + more, 20)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in got.collect()}
    assert spans[21] == [(0, 60)] and spans[22] == [(997, 200_000)] and spans[20] == []
    assert repeats.remove_repeats(no_docs).count() == 0


def test_text_ids_are_ordered_by_bytes(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    df = spark.createDataFrame([(x, passage) for x in ("b", "é", "a", "Z")], "doc_id string, text string").repartition(2)
    assert {r.doc_id: r.n_removed for r in repeats.remove_repeats(df).collect()} == {"Z": 0, "a": 25, "b": 25, "é": 25}


def test_automaton_finds_every_phrase():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["a", "b", "c"], k=rng.randint(0, 80))).encode() for _ in range(30)]
    b = repeats.Block(list(range(30)), texts, 8, 3)
    some = b.at[::3]
    want = np.isin(b.hash(0, b.at, 3), b.hash(0, some, 3))
    assert b.located(some.tolist()).tolist() == np.flatnonzero(want).tolist()


def test_spelt_words_keep_apart():
    """The automaton reads word numbers, a few characters a word, whatever the length of the words."""
    for n in (1, 2, 64, 65, 4096, 4097, 300_000):
        codes = np.array([0, n - 1, n // 2, 0, n // 3])
        text, size = repeats._spelt(codes, n)
        words = [text[i * size:(i + 1) * size] for i in range(5)]
        assert len(text) == 5 * size and 64 ** size >= n and [words.index(x) for x in words] == [codes.tolist().index(x) for x in codes.tolist()]
        assert all(text.find(x) % size == 0 for x in words)
    rng = random.Random(2)
    texts = [" ".join("w" * 40 + str(rng.randrange(5000)) if rng.random() < 0.5 else "a" for _ in range(rng.randint(0, 300))).encode() for _ in range(60)]
    b = repeats.Block(list(range(120)), texts * 2, 8, 3)
    some = b.at[::4]
    assert len(repeats._spelt(b.codes, b.n_codes)[0]) < len(b"".join(texts)) / 4
    assert b.located(some.tolist()).tolist() == np.flatnonzero(np.isin(b.hash(0, b.at, 3), b.hash(0, some, 3))).tolist()
