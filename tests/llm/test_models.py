"""Language, HTML text, SentencePiece and line quality: held-out accuracy, exact round trips, edge cases; and the
registered queries and the pipeline on the smallest tables."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from pagesmith.llm import html_extract, language_id, quality_crf, sentencepiece_fst
from pagesmith.llm.common import hash_sample
from pagesmith.llm.queries import QUERIES, held_out, piece_model

SF = "/root/testdata/sf0.001"
needs_model = pytest.mark.skipif(not os.path.exists(piece_model()), reason="no piece model here")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- language

def test_languages_of_held_out_rows(spark, edge_docs, edge_rows, no_docs):
    docs = documents(spark)
    model = language_id.train(docs, ~held_out("doc_id", 5, 0))
    rows = language_id.predict(docs.where(held_out("doc_id", 5, 0)), model).collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    edge = language_id.predict(edge_docs, model)
    assert edge.count() == len(edge_rows) and language_id.predict(no_docs, model).count() == 0
    for r in edge.collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and (r.lang_pred != "und" or r.score == 0)
    nothing = language_id.train(docs.where("false"), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(edge_docs, nothing).collect()} == {"und"}


def test_presence_kernel_of_blocks_equals_the_whole(monkeypatch):
    text = "".join(random.Random(2).choices("abcde fghij.ÄÖ\n1", k=5000))
    whole = language_id.presence(text)[0]
    monkeypatch.setattr(language_id, "BLOCK_CHARS", 700)
    parts = language_id.presence(text)[0]
    # a block starts and ends with a space of its own: no n-gram is lost, few are added
    assert not (whole & ~parts).any() and (parts.sum() - whole.sum()) <= 60


# ---- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies here.</p></div><article><h1>Title &amp; more</h1><p>First  line
of the text, long enough to be one.</p><div class="ad">Buy now</div><p><b>Second line &lt;x&gt; unclosed<br><p>Third line, also
long enough to be a paragraph.</p></article><section id="comments"><div class="comment"><p>I do not agree with this.</p></div></section>
<form><p>Subscribe</p><input></form><footer>&copy; someone</footer></body></html>"""


def test_main_text_of_a_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html_extract.train(pages)
    df = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "plain <i>words</i>"), (1, "u", PAGE)],
                               "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = html_extract.extract_pages(df, model).collect()
    want = "Title & more\nFirst line of the text, long enough to be one.\nSecond line <x> unclosed\nThird line, also long enough to be a paragraph."
    assert [r.text for r in rows if r.page_id == 1] == [want, want] and all(r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.page_id in (2, 3)} == {""} and [r.text for r in rows if r.page_id is None] == ["plain words"]
    assert html_extract.extract_pages(df.where("false"), model).count() == 0


def test_articles_of_the_test_pages_come_out_whole(spark):
    import html
    import re
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages, html_extract.train(pages)).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def test_end_tags_are_found_over_many_unclosed_elements():
    def texts(page):
        nodes, runs = html_extract.parse(page)
        return [(nodes[n].tag, s) for n, s in runs if n >= 0 and s.strip()]
    article = "<article><p>First.</p><p>Second.</p></article>"
    want = [("p", "First."), ("p", "Second.")]
    options = "".join(f"<option>Land {i}" for i in range(200))
    assert texts(f"<form><select>{options}</select></form>{article}") == want
    assert texts(f"<select><optgroup label=a>{options}<optgroup label=b>{options}</select>{article}") == want
    assert texts(f"<select>{options.replace('Land', '<b>Land')}</select>{article}") == want
    for box in ("nav", "aside", "div"):
        nodes, runs = html_extract.parse(f"<{box}>{'<font><i>x' * 200}</{box}>{article}")
        assert [nodes[nodes[n].parent].tag for n, s in runs if n >= 0 and s.endswith(".")] == ["article"] * 2
        assert [x.parent for x in nodes if x.tag == "article"] == [0]
    # an option ends the one before it, however it is nested, and no option of another list
    nodes, _ = html_extract.parse('<select><option class="menu">a<option class="menu">b<optgroup class="menu"><option class="menu">c</select>')
    assert [(x.tag, x.depth) for x in nodes[1:]] == [("option", 1), ("option", 1), ("optgroup", 1), ("option", 2)]


def test_siblings_of_long_articles(spark):
    """Place and neighbours of every block, however many there are; adverts among some hundred paragraphs go."""
    def long_page(n, box):
        blocks = [f"<p>Paragraph number {i} tells a part of the story, and is long enough to be one.</p>" for i in range(n)]
        for i in range(n - n % 20, 0, -20):
            blocks.insert(i, f'<div class="advert"><a href=/b>Buy offer {i} today</a></div>')
        return f"<body><nav><ul><li><a href=/>Home</a></li></ul></nav><{box}>{''.join(blocks)}</{box}><footer>someone</footer></body>", len(blocks)
    page, n = long_page(300, "article")
    nodes, _ = html_extract.parse(page)
    x = html_extract.features(nodes)
    box = next(i for i, node in enumerate(nodes) if node.tag == "article")
    blocks = nodes[box].children
    assert len(blocks) == n == x[blocks[0], 9]
    assert np.allclose(x[blocks, 10], np.arange(n) / (n - 1))
    advert = [nodes[i].tag == "div" for i in blocks]
    beside = [any(advert[max(0, k - 1):k] + advert[k + 1:k + 2]) for k in range(n)]
    assert sum(beside) == 29 and np.array_equal(x[blocks, 12] > 0, beside)
    near = [sum(nodes[j].chars for j in blocks[max(0, k - 1):k] + blocks[k + 1:k + 2]) for k in range(n)]
    assert np.allclose(x[blocks, 13], [s / nodes[i].chars for i, s in zip(blocks, near)])

    rows, _ = html_extract.training_rows([long_page(300, "div")[0]])
    assert rows[:, 9].max() >= 300  # whole articles are trained on
    model = html_extract.train(spark.read.parquet(f"{SF}/pages.parquet"))
    for box in ("article", 'div class="content"'):
        text = html_extract.extract([long_page(300, box)[0].replace('</div class="content">', "</div>")], model)[0]
        assert text.split("\n") == [f"Paragraph number {i} tells a part of the story, and is long enough to be one." for i in range(300)]


def test_no_node_is_kept_in_a_rejected_one():
    rng = np.random.default_rng(4)
    nodes, _ = html_extract.parse("<div><section><p>a</p><p>b</p></section><p>c</p></div><div><p>d</p></div>" * 5)
    for _ in range(20):
        margin = rng.normal(size=len(nodes))
        keep = html_extract.decode(nodes, margin)
        assert all(keep[n.parent] or not keep[i] for i, n in enumerate(nodes) if i)

        def best(i):  # exhaustive optimum of a subtree whose root is kept
            own = margin[i] if nodes[i].chars and i else 0.0
            return own + sum(max(0.0, best(c)) for c in nodes[i].children)
        assert np.isclose(sum(margin[i] for i in range(1, len(nodes)) if keep[i] and nodes[i].chars), best(0))


# ---- SentencePiece

@needs_model
def test_pieces_equal_the_library_and_round_trip(spark, edge_docs, edge_rows, no_docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    t = sentencepiece_fst.Transducer(piece_model())
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcdefghij  \n\té\U0001f600▁ﬁ中.,the0123  ", k=rng.randint(0, 50))) for _ in range(800)]
    texts += [r.text for r in documents(spark).limit(60).collect()]
    for x in texts:
        ids = np.frombuffer(t.encode(x), "<i4").tolist()
        assert ids == sp.encode(x) and t.decode(ids) == sp.decode(ids)
    rows = sentencepiece_fst.encode_documents(edge_docs, piece_model()).collect()
    assert len(rows) == len(edge_rows) and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
    assert sorted((r.doc_id or 0, r.ids) for r in rows) == sorted((i or 0, sp.encode(x or "")) for i, x in edge_rows)
    assert sentencepiece_fst.encode_documents(no_docs, piece_model()).count() == 0
    back = spark.createDataFrame([(sp.encode("Some text é"),), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in back.select(sentencepiece_fst.decode(F.col("ids"), piece_model(), spark)).collect()] == ["Some text é", None, ""]


@needs_model
def test_viterbi_is_the_lightest_path():
    t = sentencepiece_fst.Transducer(piece_model())
    t.ids = {"a": 1, "b": 2, "ab": 3, "aba": 4, "ba": 5}
    t.score = {"a": -1.0, "b": -1.5, "ab": -1.2, "aba": -4.0, "ba": -1.1}
    t.prefixes, t.longest, t.uncovered, t.bpe = {p[:k] for p in t.ids for k in range(1, 4)}, 3, -20.0, False

    def weight(parts):
        return -sum(t.score.get(p, t.uncovered) for p in parts)

    def every(s):
        return [[]] if not s else [[s[:k], *rest] for k in range(1, len(s) + 1) if s[:k] in t.ids or k == 1 for rest in every(s[k:])]
    for s in ("abab", "abba", "aabac", "cab", "bababa"):
        assert weight(t.shortest_path(s)) == pytest.approx(min(map(weight, every(s))))


# ---- line quality

def test_forward_backward_equals_enumeration():
    import itertools
    rng = np.random.default_rng(0)
    model = quality_crf.Chain(rng.normal(size=(quality_crf.WIDTH, 2)), rng.normal(size=(2, 2)))
    docs = [rng.random((n, quality_crf.WIDTH)).astype(np.float32) for n in (1, 4, 2, 5)]
    p, pairs = model.marginals(docs, np.ones(4))
    want_pairs = np.zeros((2, 2))
    for d, got in zip(docs, p):
        s = d @ model.weights
        total, want, own = 0.0, np.zeros((len(d), 2)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=len(d)):
            w = np.exp(sum(s[t, y[t]] for t in range(len(d))) + sum(model.steps[a, b] for a, b in zip(y, y[1:])))
            total += w
            for t, c in enumerate(y):
                want[t, c] += w
            for a, b in zip(y, y[1:]):
                own[a, b] += w
        assert np.allclose(got, want / total)
        want_pairs += own / total
    assert np.allclose(pairs, want_pairs)


def test_quality_of_held_out_rows(spark, edge_docs, edge_rows, no_docs):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_crf.train(docs, labels, ~held_out("doc_id", 3, 1))
    test = docs.join(labels.where(held_out("doc_id", 3, 1)), "doc_id").select("quality", quality_crf.quality(F.col("text"), model, spark).alias("s"))
    rows = test.collect()
    assert np.mean([(r.s >= 0.5) == (r.quality == 1) for r in rows]) >= 0.95
    edge = edge_docs.select("text", quality_crf.quality(F.col("text"), model, spark).alias("s")).collect()
    assert len(edge) == len(edge_rows) and all(0 <= r.s <= 1 and (r.s == 0 or (r.text or "").strip()) for r in edge)
    assert no_docs.select(quality_crf.quality(F.col("text"), model, spark)).count() == 0
    unknown = quality_crf.train(docs, labels.where("quality = 1"), F.lit(True))
    assert {round(x, 9) for x in unknown.score(["some words", "x"])} == {0.5}


# ---- registration and pipeline

def test_one_query_per_operator():
    names = [k for k in E.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and set(names) == set(QUERIES)
    assert "pipeline" in E.queries() and len(corpus_pipeline.STAGES) == 5
    assert {"op2_url_filters", "op7_quality_rules", "op11_repeated_passages", "op12_fill_in_middle", "op13_importance_resampling"} <= set(E.oracle_sql())


@needs_model
def test_pipeline_keeps_columns_and_clean_documents(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        before, docs = docs, spark.createDataFrame(out.collect(), out.schema)
        gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()}
        assert len(gone) <= 0.2 * before.count(), name
    assert not stage(spark, docs.where("false"), SF).count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.where("not round_trip").count() == 0


@needs_model
def test_pipeline_of_null_and_repeated_ids_and_of_no_rows(spark, tmp_path):
    """Rows without text go (no language); of equal texts the one of the smaller id keeps its lines; rows of one id with
    different texts are documents of their own; a table without rows gives none."""
    docs, d = documents(spark), str(tmp_path / "odd")
    fresh = [" ".join(f"{w}{k}" for w in "the river runs past old houses and quiet fields towards a distant sea".split()) for k in range(3)]
    odd = [(None, fresh[0]), (None, fresh[0]), (None, None), (None, ""), (-1, fresh[1]), (-1, fresh[2]), (-2, fresh[1])]
    extra = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    docs.unionByName(extra.select(*[F.col(f.name).cast(f.dataType) for f in docs.schema])).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    out = corpus_pipeline.run(spark, d)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert out.where("not round_trip").count() == 0 and len(ids) > 50
    assert ids.count(None) <= 1 and ids.count(-1) <= 2 and ids.count(-2) == 1  # -2 comes before -1 and keeps the text both have
    none = str(tmp_path / "none")
    docs.where("false").write.parquet(f"{none}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{none}/benchmark.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0


def test_native_plans_have_no_python(spark):
    for k in ("op1_benchmark_decontamination", "op2_url_filters", "op5_pii", "op7_quality_rules", "op8_line_dedup"):
        p = QUERIES[k](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in p and "InArrow" not in p and "InPandas" not in p and "CartesianProduct" not in p, k


def test_html_rules_for_attributes_and_comments():
    text = lambda h: html_extract.assemble(html_extract.parse(h)[1], np.ones(99, bool))
    assert text("<p title=Bob's>One it's two.</p><p>Three isn't four.</p>") == "One it's two.\nThree isn't four."
    assert text("<p>One.</p><!--> <p>Two.</p>") == "One.\nTwo."
    assert text("<p>One.</p><!---><p>Two.</p><!-- a > b --!><p>Three.</p><!-- open <p>Four.</p>") == "One.\nTwo.\nThree."
    assert text('<p title="a > b" data-x=\'c > d\' e= "f>">One.</p><p a=>Two.</p><p a="b>Three.</p>') == "One.\nTwo.\nThree."


def test_a_million_lines_are_scored_in_bounded_memory():
    import resource
    model = quality_crf.Chain(np.random.default_rng(1).normal(0, 0.3, (quality_crf.WIDTH, 2)), np.array([[0.4, -0.4], [-0.4, 0.4]]))
    short = [f"a line of text {i}\nand more !!" for i in range(127)]
    alone = model.score(short)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    together = model.score(short + ["\n".join(f"line {i % 1000}" for i in range(1_000_000))])
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    assert np.allclose(together[:-1], alone) and 0 < together[-1] < 1
    assert grown < 1500, grown


def test_hash_samples_are_the_lowest_of_every_group(spark):
    df = spark.range(30_000).selectExpr("id", "xxhash64(id) as r", "if(id % 100 = 0, 'rare', if(id % 7 = 0, null, 'hot')) as g")
    rank = lambda r: (r.r & (2**64 - 1)) >> 1
    rows = df.collect()
    want = {g: sorted((x for x in rows if x.g == g), key=rank)[:500] for g in ("rare", "hot")}
    got = hash_sample(df, 500, "r", ("g",)).collect()
    assert {g: {x.id for x in got if x.g == g} for g in want} == {g: {x.id for x in xs} for g, xs in want.items()}
    assert {x.id for x in hash_sample(df, 50, "r").collect()} == {x.id for x in sorted(rows, key=rank)[:50]}
    assert hash_sample(df.where("false"), 5, "r").count() == hash_sample(df.where("false"), 5, "r", ("g",)).count() == 0
    same = df.selectExpr("id", "1L as r", "g")  # a rank that is no hash: still the asked number
    assert hash_sample(same, 5, "r").count() == 5 and hash_sample(same, 5, "r", ("g",)).count() == 10
