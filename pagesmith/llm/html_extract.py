"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded hierarchically.

A page becomes a small tree of its block elements (and of elements with a class, id or role).  Every node
gets a probability of belonging to the article from features of its subtree (text, link and tag density),
attribute tokens, depth and siblings.  Decoding picks the likeliest labelling in which a node belongs to the
article only if its parent does, by one bottom-up pass; so no article node lies in a rejected ancestor.

Pages carry no labels.  The trees are fitted on a bounded sample of the pages themselves: article and
boilerplate blocks are told apart where pages mark them with HTML's own elements, and are then put into
varied page layouts (other containers, class names, notices, side bars, forms, reader comments), where the
label of every node is known.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.llm import gbt
from pagesmith.llm.common import hash_sample

#: Pages of the training sample, and the longest page that enters it.
TRAIN_PAGES, TRAIN_CHARS = 160, 200_000
BATCH = 128

# HTML's block, void and never-shown elements, and attribute tokens by what they usually mark.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
             "thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head title script style noscript template iframe object svg canvas select textarea button".split())
RAW = set("script style textarea title noscript iframe template".split())
CLOSES_P = BLOCKS - {"html", "body"}
ENDS_OPTION = {"option": ("option",), "optgroup": ("option", "optgroup")}
OPTION_SCOPE = BLOCKS | {"#root", "select", "datalist"}
TOKENS = {
    "content": "article content post entry body main story text blogpost page",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pager pagination toc topbar",
    "frame": "header footer head foot masthead copyright legal site branding logo bottom top",
    "side": "sidebar side aside widget rail related recommended more tags links archive popular trending",
    "advert": "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner",
    "notice": "cookie cookies consent notice alert popup modal gdpr privacy overlay message warning disclaimer",
    "form": "form newsletter subscribe signup login register search field contact",
    "social": "share sharing social follow facebook twitter like",
    "comment": "comment comments reply replies respond discussion disqus feedback reader responses thread",
}
TOKEN_GROUP = {t: g for g, ts in enumerate(TOKENS.values()) for t in ts.split()}
TAGS = ("article", "main", "section", "div", "p", "heading", "nav", "header", "footer", "aside", "form", "list", "li", "table", "quote")
TAG_GROUP = {**{t: t for t in TAGS}, **{f"h{i}": "heading" for i in range(1, 7)}, "ul": "list", "ol": "list", "dl": "list", "menu": "nav",
             "dt": "li", "dd": "li", "td": "table", "tr": "table", "th": "table", "tbody": "table", "thead": "table", "blockquote": "quote",
             "pre": "quote", "fieldset": "form", "label": "form", "address": "footer", "dialog": "aside"}

# comments end as HTML says (also "<!-->" and "--!>"); a quote opens a value only behind an equals sign
TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))*+)>"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    groups: frozenset = frozenset()
    nth: int = 0            # among the parent's children
    chars: int = 0          # of the subtree
    link_chars: int = 0
    own: int = 0
    stops: int = 0
    words: int = 0
    nodes: int = 1
    paragraphs: int = 0
    children: list = field(default_factory=list)


def parse(html: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order (0 is the root) and (node, text) runs; a run with node -1 ends a block."""
    nodes, runs = [Node("#root", -1, 0)], []
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements with their node (an inline one has its parent's)
    opened: Counter[str] = Counter()  # open elements per tag
    hidden = links = 0
    at, html = 0, html or ""

    def text(s: str):
        if hidden or not s:
            return
        node = stack[-1][1]
        runs.append((node, s))
        n = len(s.strip())
        if n:
            x = nodes[node]
            x.own += n
            x.chars += n
            x.link_chars += n if links else 0
            x.stops += s.count(".") + s.count(",")
            x.words += s.count(" ") + 1

    def pop():
        nonlocal hidden, links
        tag, _ = stack.pop()
        opened[tag] -= 1
        hidden -= tag in HIDDEN
        links -= tag == "a"
        if tag in BLOCKS:
            runs.append((-1, ""))

    while True:
        m = TAG.search(html, at)
        text(html[at:m.start() if m else len(html)])
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag in BLOCKS:
                runs.append((-1, ""))
            continue
        attributes = m[3] or m[6] or ""
        if tag in CLOSES_P:  # an open paragraph ends where another block begins
            for k in range(len(stack) - 1, 0, -1):
                t = stack[k][0]
                if t == "p" or t == tag and tag in ("li", "dt", "dd", "tr", "td", "th"):
                    while len(stack) > k:
                        pop()
                    break
                if t in BLOCKS:
                    break
        for ended in ENDS_OPTION.get(tag, ()):  # an open option ends where another one or a group begins
            k = len(stack) - 1
            while opened[ended] and stack[k][0] != ended and stack[k][0] not in OPTION_SCOPE:
                k -= 1
            if stack[k][0] == ended:
                while len(stack) > k:
                    pop()
        if tag in BLOCKS:
            runs.append((-1, ""))
        if tag in VOID:
            if tag == "br":
                text(" ")
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\b", re.I).search(html, at)
            at = end.start() if end else len(html)
        marks = [v for a in ATTRIBUTE.finditer(attributes) for v in a.groups()[1:] if v] if attributes else []
        groups = frozenset(TOKEN_GROUP[w] for v in marks for w in map(str.lower, WORD.findall(v)) if w in TOKEN_GROUP)
        node = stack[-1][1]
        if tag in BLOCKS or groups:
            nodes.append(Node(tag, node, nodes[node].depth + 1, groups, len(nodes[node].children)))
            node = len(nodes) - 1
            nodes[nodes[node].parent].children.append(node)
        if attributes.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        stack.append((tag, node))
        opened[tag] += 1
        hidden += tag in HIDDEN
        links += tag == "a"
    for i in range(len(nodes) - 1, 0, -1):
        x, p = nodes[i], nodes[nodes[i].parent]
        p.chars += x.chars
        p.link_chars += x.link_chars
        p.stops += x.stops
        p.words += x.words
        p.nodes += x.nodes
        p.paragraphs += x.paragraphs + (x.tag == "p" and x.own > 0)
    return nodes, runs


N_FEATURES = 14 + 2 * len(TOKENS) + 2 * len(TAGS)


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node: subtree size and densities, siblings, depth, own and inherited tags and tokens."""
    out = np.zeros((len(nodes), N_FEATURES), np.float32)
    total = max(nodes[0].chars, 1)
    tags0, above0 = 14, 14 + len(TOKENS)
    own_tag0, above_tag0 = 14 + 2 * len(TOKENS), 14 + 2 * len(TOKENS) + len(TAGS)
    place = {t: i for i, t in enumerate(TAGS)}
    for i, x in enumerate(nodes):
        p = nodes[x.parent] if i else x
        siblings = p.children if i else [0]
        k = x.nth
        near = [nodes[j] for j in siblings[max(0, k - 1):k + 2] if j != i]
        out[i, :14] = (
            np.log1p(x.chars), x.link_chars / max(x.chars, 1), x.chars / x.nodes, x.own / max(x.chars, 1), x.chars / total,
            x.chars / max(p.chars, 1), x.stops / max(x.words, 1), x.words / x.nodes, x.depth, len(siblings), k / max(len(siblings) - 1, 1),
            np.log1p(x.paragraphs), max((y.link_chars / max(y.chars, 1) for y in near), default=0.0),
            sum(y.chars for y in near) / max(x.chars, 1))
        for g in x.groups:
            out[i, tags0 + g] = 1
        if x.tag in TAG_GROUP:
            out[i, own_tag0 + place[TAG_GROUP[x.tag]]] = 1
        if i:
            out[i, above0:above0 + len(TOKENS)] = np.maximum(out[x.parent, above0:above0 + len(TOKENS)], out[x.parent, tags0:tags0 + len(TOKENS)])
            out[i, above_tag0:] = np.maximum(out[x.parent, above_tag0:], out[x.parent, own_tag0:own_tag0 + len(TAGS)])
    return out


def decode(nodes: list[Node], margin: np.ndarray) -> np.ndarray:
    """Likeliest labels under "article only if the parent is": a rejected node rejects its subtree.
    The root (and html, body) belongs to the article; nodes without text weigh nothing."""
    inside = np.array([m if x.chars else 0.0 for x, m in zip(nodes, margin)])  # log-odds of the best labelling below
    keep = np.zeros(len(nodes), bool)
    for i in range(len(nodes) - 1, 0, -1):
        if nodes[i].tag in ("html", "body"):
            inside[i] = max(inside[i], 0.0) + 1e6
        keep[i] = inside[i] > 0
        if keep[i]:
            inside[nodes[i].parent] += inside[i]
    keep[0] = True
    for i in range(1, len(nodes)):
        keep[i] &= keep[nodes[i].parent]
    return keep


def assemble(runs: list[tuple[int, str]], keep: np.ndarray) -> str:
    """Text of the kept nodes: references decoded, white space of a block made one space, a line per block."""
    blocks, block = [], []
    for node, s in [*runs, (-1, "")]:
        if node < 0:
            if block:
                t = " ".join(html_lib.unescape("".join(block)).split())
                if t:
                    blocks.append(t)
                block = []
        elif keep[node]:
            block.append(s)
    return "\n".join(blocks)


def extract(pages: list[str | None], model: gbt.Trees) -> list[str]:
    """Main texts of a batch of pages."""
    parsed = [parse(p) for p in pages]
    margins = model.margin(np.concatenate([features(n) for n, _ in parsed])) if parsed else []
    out, at = [], 0
    for nodes, runs in parsed:
        out.append(assemble(runs, decode(nodes, margins[at:at + len(nodes)])))
        at += len(nodes)
    return out


# ---- training ----

def _marked(nodes: list[Node]) -> tuple[bool, list[bool]]:
    """Whether a page marks its article by HTML's elements, and which nodes are in it (else: by link density)."""
    marked = any(x.tag in ("article", "main") for x in nodes)
    inside = [False] * len(nodes)
    for i, x in enumerate(nodes):
        good = x.tag in ("article", "main") if marked else x.tag in ("p", "h1", "h2", "blockquote") and x.link_chars * 3 < x.chars
        inside[i] = (i > 0 and inside[x.parent] or good) and x.tag not in ("nav", "footer", "aside", "form")
    return marked, inside


def _pieces(nodes: list[Node], runs: list[tuple[int, str]]) -> tuple[list[str], list[str]]:
    """Article and other texts of a page."""
    _, inside = _marked(nodes)
    texts: dict[int, list[str]] = {}
    for node, s in runs:
        if node >= 0 and s.strip():
            texts.setdefault(node, []).append(s)
    both: tuple[list[str], list[str]] = ([], [])
    for node, parts in texts.items():
        both[0 if inside[node] else 1].append("".join(parts))
    return both


def _layout(rng: random.Random, article: list[str], other: list[str], foreign: list[str]) -> list[tuple[str, bool]]:
    """A page in a random layout as (markup, is article) parts at the level of blocks."""
    pick = lambda xs: rng.choice(xs)
    named = lambda group: pick(list(TOKENS.values())[group].split())
    mark = lambda group: pick([f' class="{named(group)}"', f' id="{named(group)}"', f' class="{named(group)} box"', f' class="site-{named(group)}"'])
    short = lambda: pick(other or ["Home"])[:rng.randint(3, 120)]
    long = lambda: pick(foreign or article or ["text"])
    links = lambda n: "<ul>" + "".join(f'<li><a href="/x">{short()[:24]}</a></li>' for _ in range(n)) + "</ul>"
    group = {k: i for i, k in enumerate(TOKENS)}
    menu = lambda: pick([f"<nav>{links(rng.randint(3, 9))}</nav>", f"<div{mark(group['menu'])}>{links(rng.randint(3, 9))}</div>"])
    frame = lambda t: pick([f"<{t}>{short()}</{t}>", f"<{t}><a href=/>{short()}</a></{t}>", f"<{t}><p>{short()}</p></{t}>", f"<{t}>{short()} {links(2)}</{t}>", f"<div{mark(group['frame'])}>{short()}</div>"])
    side = lambda: pick([f"<aside><p>{long()}</p></aside>", f"<div{mark(group['side'])}><h3>{short()[:20]}</h3>{links(4)}</div>",
                         f"<aside{mark(group['side'])}><p>{short()}</p></aside>", f"<div{mark(group['side'])}><p>{long()}</p></div>"])
    advert = lambda: f"<div{mark(group['advert'])}>{pick([short(), long(), '<p>' + long() + '</p>'])}</div>"
    notice = lambda: f"<div{mark(group['notice'])}><p>{pick([short(), long()])}</p></div>"
    form = lambda: pick([f"<form><label>{short()[:20]}</label><input><p>{short()}</p></form>", f"<form{mark(group['form'])}><p>{long()}</p><input></form>",
                         f"<div{mark(group['form'])}><p>{short()}</p></div>"])
    social = lambda: f"<div{mark(group['social'])}>{links(3)}</div>"
    comments = lambda: (f"<{pick(['section', 'div'])}{mark(group['comment'])}>" + "".join(
        f'<div class="comment"><p>{long()}</p></div>' if rng.random() < 0.7 else f"<p>{long()}</p>" for _ in range(rng.randint(1, 4))) + "</section></div>")
    kinds = [menu, lambda: frame("header"), side, advert, notice, form, social]
    title, rest = article[:1], article[1:]
    shapes = ["<p>{}</p>"] * 6 + ["<p><b>{}</b></p>", "<p>{}", "<div>{}</div>", "<blockquote><p>{}</p></blockquote>", "<h2>{:.60}</h2>",
                                  "<p>{:.40}</p>", '<p><a href="/y">{:.30}</a> {}</p>']
    body = [(pick(["<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h2>{}</h2>"]).format(t), True) for t in title]
    for t in rest:
        if rng.random() < 0.12:
            body.append(("<ul>" + "".join(f"<li>{w}</li>" for w in re.findall(r"\S+(?: \S+){0,9}", t)[:6]) + "</ul>", True))
        elif rng.random() < 0.04:
            body.append((f"<table><tr><td>{t[:60]}</td><td>{t[60:140]}</td></tr></table>", True))
        else:
            body.append((pick(shapes).replace("{}", "{0}").replace("{:", "{0:").format(t), True))
    for _ in range(rng.randint(0, 2)):
        body.insert(rng.randint(1, len(body)) if body else 0, (pick([advert, notice, form, social, side])(), False))
    box = pick(["<article>", "<article>", "<main>", f"<div{mark(group['content'])}>", f"<section{mark(group['content'])}>", "<div>", "<main><article>", "", ""])
    close = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", box)))
    before = [(pick(kinds)(), False) for _ in range(rng.randint(1, 4))]
    after = [(pick([side, advert, form, social, notice])(), False) for _ in range(rng.randint(0, 3))]
    after += [(comments(), False)] * (rng.random() < 0.5) + [(frame("footer"), False)]
    return [*before, (box, True), *body, (close, True), *after]


def training_rows(pages: list[str], seed: int = 11, layouts: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of re-arranged pages, and of the pages that mark their article."""
    rng, xs, ys = random.Random(seed), [], []
    parsed = [parse(p) for p in pages]
    pieces = [_pieces(*x) for x in parsed]
    for nodes, _ in parsed:
        marked, inside = _marked(nodes)
        rows = [k for k, x in enumerate(nodes) if x.chars and x.tag not in ("#root", "html", "body")]
        if marked and rows:
            xs.append(features(nodes)[rows])
            ys.append(np.array(inside, float)[rows])
    for i, (article, other) in enumerate(pieces):
        foreign = pieces[i - 1][0]
        for k in range(layouts if article else 0):
            page, spans = "", []
            for markup, good in _layout(rng, article if k == 0 else article[:40], other, foreign):
                spans += [good] * markup.count("<")  # the label of every tag
                page += markup
            nodes, _ = parse(page)
            starts = [g for m, g in zip(re.finditer(r"<(/?)(\w+)([^>]*)>", page), spans)
                      if not m[1] and (m[2] in BLOCKS or any(w.lower() in TOKEN_GROUP for w in WORD.findall(m[3]) if "=" in m[3]))
                      and m[2] not in VOID]
            if len(starts) != len(nodes) - 1:
                continue  # text with a stray "<": such a layout is left out
            rows = [k for k, x in enumerate(nodes) if k and x.chars and x.tag not in ("html", "body")]
            xs.append(features(nodes)[rows])
            ys.append(np.array([starts[k - 1] for k in rows], float))
    if not xs:
        return np.zeros((0, N_FEATURES)), np.zeros(0)
    return np.concatenate(xs), np.concatenate(ys)


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", rows: int = TRAIN_PAGES,
          chars: int = TRAIN_CHARS) -> gbt.Trees:
    """Trees fitted on up to ``rows`` pages of at most ``chars`` characters, chosen by a hash over the whole
    table.  Without any page everything is article."""
    d = pages.where(F.length(html_col).between(1, chars)).select(F.xxhash64(F.xxhash64(id_col), html_col).alias("r"), F.col(html_col).alias("html"))
    chosen = [r["r"] for r in hash_sample(d.select("r").distinct(), rows, "r").collect()]  # hashes first, then only their pages
    found = d.where(F.col("r").isin(chosen)).dropDuplicates(["r"]).collect() if chosen else []
    x, y = training_rows([r["html"] for r in sorted(found, key=lambda r: r["r"])])
    return gbt.fit(x, y, trees=50, depth=4) if len(y) else gbt.Trees(bias=2.0)


def main_text(html: Column, model: gbt.Trees, spark) -> Column:
    """Main text of each page (empty for null and for pages without text)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        rows, out = pages.tolist(), []
        for k in range(0, len(rows), BATCH):
            out += extract(rows[k:k + BATCH], shared.value)
        return pd.Series(out, dtype=object)

    return text(html)


def extract_pages(pages: DataFrame, model: gbt.Trees, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) per row; null html gives an empty text.  Nulls in the other columns, repeated
    rows and extra columns are allowed."""
    t = main_text(F.col(html_col), model, pages.sparkSession)
    out = pages.select(F.col(id_col), F.col(url_col), t.alias("text"))
    return out.select(id_col, url_col, "text", F.length("text").cast("long").alias("n_chars"))
