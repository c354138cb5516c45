"""Per-page helper for the markup operators: a tolerant element tree over ``html.parser``.

Tree rules (those of the common "html.parser" tree builders): void elements never take children;
an end tag closes the most recent open element with that name and everything opened after it, and is
ignored when no such element is open; elements still open at the end are closed there; character
references are decoded; comments, declarations and text inside script/style/template/rt/rp (at any
depth) are not part of an enclosing element's text, only of that element's own text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split())
RAW_TEXT = frozenset(("script", "style", "template", "rt", "rp"))


class _Raw(str):
    """Text of a script/style/template element: kept, but not part of an ancestor's text."""


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag = tag
        self.attrs = attrs
        self.children: list = []

    def iter(self):
        """Descendant elements in document order (pre-order), self excluded."""
        stack = list(reversed([c for c in self.children if isinstance(c, Node)]))
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed([c for c in n.children if isinstance(c, Node)]))

    def text(self) -> str:
        """Concatenated descendant text (iterative, so deep unclosed nesting is fine)."""
        keep_raw = self.tag in RAW_TEXT
        out, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, Node):
                stack.extend(reversed(item.children))
            elif keep_raw or not isinstance(item, _Raw):
                out.append(item)
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {})
        self.stack = [self.root]
        self.open = {}
        self.raw_depth = 0

    def _node(self, tag, attrs):
        node = Node(tag, {k: ("" if v is None else v) for k, v in attrs})
        self.stack[-1].children.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        node = self._node(tag, attrs)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1
            self.raw_depth += tag in RAW_TEXT

    def handle_startendtag(self, tag, attrs):
        self._node(tag, attrs)

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        while len(self.stack) > 1:
            n = self.stack.pop()
            self.open[n.tag] -= 1
            self.raw_depth -= n.tag in RAW_TEXT
            if n.tag == tag:
                break

    def handle_data(self, data):
        self.stack[-1].children.append(_Raw(data) if self.raw_depth else data)


class _Found(Exception):
    pass


class _FirstTag(HTMLParser):
    """Stops at the first start tag matching ``step``; its attributes are kept."""

    def __init__(self, step):
        super().__init__(convert_charrefs=True)
        self.step = step
        self.attrs = None

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: ("" if v is None else v) for k, v in attrs})
        if matches(node, self.step):
            self.attrs = node.attrs
            raise _Found

    handle_startendtag = handle_starttag


def first_tag_attrs(html: str, step) -> dict | None:
    """Attributes of the first element matching one selector step, in document order, reading
    the page only up to that tag (pre-order of a tree = order of start tags)."""
    p = _FirstTag(step)
    try:
        p.feed(html)
        p.close()
    except _Found:
        pass
    return p.attrs


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


_STEP = re.compile(r"^([\w:-]+|\*)((?:\[[^\]]*\])*)$")
_ATTR = re.compile(r"\[\s*([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\]]*?))\s*\]")


def compile_step(step: str):
    """'div[class="card article-card"]' -> (tag or None, {attr: value})."""
    m = _STEP.match(step.strip())
    if not m:
        raise ValueError(f"bad selector step: {step!r}")
    tag = None if m.group(1) == "*" else m.group(1).lower()
    attrs = {a.group(1).lower(): next(g for g in a.groups()[1:] if g is not None)
             for a in _ATTR.finditer(m.group(2))}
    return tag, attrs


def _attr_ok(node: Node, name: str, want: str) -> bool:
    have = node.attrs.get(name)
    if have is None:
        return False
    if name == "class":
        tokens = have.split()
        return want in tokens or " ".join(tokens) == want
    return have == want


def matches(node: Node, step) -> bool:
    tag, attrs = step
    return (tag is None or node.tag == tag) and all(_attr_ok(node, k, v) for k, v in attrs.items())


def find_all(node: Node, step):
    return [n for n in node.iter() if matches(n, step)]


def find(node: Node, step):
    for n in node.iter():
        if matches(n, step):
            return n
    return None


def follow(node: Node | None, path) -> Node | None:
    """First match of each step, searched among the descendants of the previous match."""
    for step in path:
        if node is None:
            return None
        node = find(node, step)
    return node
