"""Fill-in-middle and importance resampling against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from pagesmith.llm import fill_in_middle as fim
from pagesmith.llm import importance


def units_of(text):
    return re.findall(r"[^\n]*\n|[^\n]+", text)


@pytest.mark.parametrize("size", [5, 16, 1 << 16])
def test_frames_cut_and_restore_like_strings(size):
    rng = random.Random(size)
    for _ in range(300):
        text = "".join(rng.choice(["a", "é", "\n", "\n", "<", "P", "S>", "中", "\U0001f600", "M<"]) for _ in range(rng.randint(0, 60)))
        if any(m in text for m in ("<P>", "<S>", "<M>")):
            continue
        ls, data = units_of(text), text.encode()
        frames = fim.store(data, size)
        assert b"".join(fim.stream(frames)) == data
        low, high = sorted(rng.randint(0, len(ls)) for _ in range(2))
        pre, mid, suf = "".join(ls[:low]), "".join(ls[low:high]), "".join(ls[high:])
        for form, want in (("psm", f"<P>{pre}<S>{suf}<M>{mid}"), ("spm", f"<S>{suf}<P>{pre}<M>{mid}")):
            out, p, m = fim.rearrange(frames, len(ls), len(text), low, high, form)
            assert (b"".join(fim.stream(out)).decode(), p, m) == (want, len(pre), len(mid))
            assert b"".join(fim.restore(out, form)) == data
            # sentinels that lie across frames are found as well
            assert b"".join(fim.restore(fim.store(want.encode(), 5), form)) == data


def brute_fim(doc_id, text):
    text, ls = text or "", units_of(text or "")
    h = [int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(ls) + 1), h[1] % (len(ls) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(ls), "plain", None, None, text
    pre, mid, suf = "".join(ls[:a]), "".join(ls[a:b]), "".join(ls[b:])
    if h[3] % 100 < 50:
        return len(ls), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(ls), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle_edge_rows(spark, edge_docs, edge_rows, no_docs):
    long_line = "word " * 60_000 + "\n" + "é\n" * 50_000
    more = [(9, "has <S> inside\nlines"), (10, long_line), (11, "no end"), (12, "\n"), (13, "one\n"), (14, "a\nb\nc\nd\ne\nf")]
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256, r.restored_sha256)
                  for r in fim.fill_in_middle(docs).collect()), key=repr)
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    want = sorted(((d, *(w := brute_fim(d, t)), sha(w[4]), sha(t)) for d, t in edge_rows + more), key=repr)
    assert got == want
    assert fim.fill_in_middle(no_docs).count() == 0


# ---- importance resampling

def features(text):
    w = [x for x in re.split(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) if x]
    return [zlib.crc32(b" ".join(w[i:i + k])) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)], len(w)


def brute_resample(docs, target, percent=5, least=20):
    rows = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, f, _ in rows for b in f), Counter(b for x in target for b in features(x)[0])
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + 10000) / ((s[b] + 1) * (nt + 10000)))) for b in range(10000)]
    out = []
    for d, f, n in rows:
        w = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[5] = k + 1
    return out


def as_rows(df):
    return sorted((list(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_resampling_equals_brute_force(spark):
    rng = random.Random(5)
    words = ["alpha", "Beta", "été", "x", "9", "w" * 300, "中文"] + [f"t{i}" for i in range(50)]
    docs = [(i, rng.choice([" ", "-", "\n\t"]).join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(200)]
    target = [" ".join(rng.choices(words[:12], k=40)) for _ in range(20)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=30)
    assert as_rows(got) == sorted(brute_resample(docs, target, 30), key=repr)


def test_composed_crc_of_long_words():
    rng = random.Random(2)
    words = ["".join(rng.choices("abé0", k=n)) for n in (1, 2, 31, 62, 63, 64, 65, 127, 500, 5000)]
    text = " ".join(rng.choices(words, k=200))
    folded = text.encode().translate(importance.FOLD)
    assert importance.Dictionary([folded]).runs(folded)[0].tolist() == features(text)[0]


def test_resampling_edge_rows(spark, edge_docs, edge_rows, no_docs, monkeypatch):
    target = spark.createDataFrame([("the quick brown fox",), (None,)], "text string")
    want = sorted(brute_resample(edge_rows, ["the quick brown fox", None], 50), key=repr)
    for size in (importance.BLOCK_BYTES, 100):  # a block of its own for every text
        monkeypatch.setattr(importance, "BLOCK_BYTES", size)
        got = as_rows(importance.resample(edge_docs, target, percent=50))
        tied = [r[:5] for r in want if r[0] == 3]  # a repeated row: either of the two may come first
        assert [r[:5] for r in got] == [r[:5] for r in want] and len(tied) == 2
        assert sorted(r[5] or 0 for r in got) == sorted(r[5] or 0 for r in want)
    assert importance.resample(no_docs, target).count() == 0
    assert importance.resample(edge_docs, target.where("false"), percent=50).where("rank is not null").count() == sum(r[5] is not None for r in want)
