"""Page trees and simple tree matching (plain Python, used inside tasks by ``html_extract``).

``parse`` reads a page of any quality into text blocks and a *shape*: the nested block elements with runs of
equal siblings written once. ``Tree`` holds a shape or a host's template; ``align`` is simple tree matching: two nodes match if their
labels do, and their children are matched in order so that the number of matched nodes is largest.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np

from casebook.llm._common import by_value

by_value(__name__)

TAG = re.compile(
    r"""<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
# Tags whose content is never main text, and names that say so in class, id or role.
BOILER_TAGS = frozenset("""head nav footer aside form script style textarea title noscript iframe noembed noframes xmp template svg math
button select dialog menu object canvas audio video map datalist""".split())
BOILER_NAMES = frozenset("""ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline-links comment
comments commentlist complementary consent contentinfo cookie cookies copyright dialog discussion disqus footer gdpr header hidden legal login masthead
menu menubar modal nav navbar navigation newsletter notice notices pager pagination paywall popup promo promoted promotion recommended related replies
reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
# Inside an article or main part only these, as a whole name, drop an element: parts of names, and names that are topics as
# well (related, legal, search, social, ...), are left to what recurs on the host's pages.
CLEAR_NAMES = frozenset("""ad ads adsense advert adverts advertisement advertising breadcrumb breadcrumbs comment comments commentlist
complementary contentinfo cookies disqus gdpr hidden masthead menubar modal nav navbar navigation newsletter pager pagination paywall
popup promo sidebar signup sponsored toolbar""".split())
MAIN_NAMES = frozenset("""article articlebody article-body article-content entry-content main main-content post-body post-content
story-body""".split())
# An element of the key's kind is closed by the start of one of these.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "tfoot": {"tr", "td", "th", "tbody", "thead"},
}
SCOPE = frozenset("ul ol dl table select body html article section div".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADING = 3  # level of a heading inside an article or a main element
DEEPEST = 150  # elements nested deeper stand as children of the one at this depth; their text is kept


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


class _Element:
    __slots__ = ("tag", "label", "children", "boiler", "level", "no", "shape")

    def __init__(self, tag: str, label: str, boiler: bool, level: int):
        self.tag, self.label, self.boiler, self.level = tag, label, boiler, level
        self.children: list[_Element] = []
        self.no = 0
        self.shape = ""


def _open(tag: str, attributes: str, parent: _Element) -> _Element:
    """level: 3 in a heading of these, 2 inside an article, 1 inside another main element, 0 outside."""
    boiler, level, label = parent.boiler or tag in BOILER_TAGS, parent.level, tag
    if tag == "article":
        level = 2
    elif tag == "main":
        level = max(level, 1)
    elif tag in HEADINGS and level:
        level = HEADING
    elif tag == "header" and not level:
        boiler = True
    if attributes and not attributes.isspace():
        a = _attributes(attributes)
        names = " ".join(a.get(k, "") for k in ("class", "id", "role", "itemprop")).lower().split()
        main = MAIN_NAMES & set(names)
        if level or main:
            named = not CLEAR_NAMES.isdisjoint(names)
        else:
            named = not BOILER_NAMES.isdisjoint(x for n in names for x in (n, *re.split(r"[-_]+", n)))
        if named and tag not in ("html", "body", "main"):
            boiler = True
        if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
            boiler = True
        if main and not boiler:
            level = max(level, 2 if {"article", "articlebody", "article-body", "article-content"} & main else 1)
        if "class" in a:
            label += "." + re.sub(r"\d+", "0", ".".join(sorted(a["class"].lower().split()))).translate(_PLAIN)
    return _Element(tag, label, boiler, level)


_PLAIN = {ord(c): "_" for c in "(),"}


def parse(html: str) -> tuple[str, list[tuple[int, int, str]]]:
    """(shape, blocks) of a page; a block is (number of its node in the shape, level, text). Boilerplate is left out."""
    root = _Element("#", "#", False, 0)
    stack, blocks, segments = [root], [], []
    hidden = 0  # depth of inline boilerplate
    pos, n, lower = 0, len(html), None

    def flush() -> None:
        if segments:
            text = " ".join("".join(segments).split())
            if text:
                blocks.append((stack[-1], text))
            segments.clear()

    def pop(k: int) -> None:
        flush()
        del stack[k:]

    while pos < n:
        m = TAG.search(html, pos)
        end = m.start() if m else n
        if end > pos and not stack[-1].boiler and not hidden:
            text = html[pos:end]
            segments.append(unescape(text) if "&" in text else text)
        if not m:
            break
        pos = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in INLINE:
            if tag == "br":
                segments.append(" ")
            elif closing:
                hidden = max(0, hidden - 1)
            elif hidden or (attributes and _open("span", attributes, stack[-1]).boiler):
                hidden += tag not in VOID
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    hidden = 0
                    pop(k)
                    break
            continue
        flush()
        hidden = 0
        if tag == "p" or tag not in VOID:  # a block ends an open paragraph
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    pop(k)
                    break
                if stack[k].tag in SCOPE:
                    break
        if tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSES[tag]:
                    pop(k)
                    break
                if stack[k].tag in SCOPE:
                    break
        element = _open(tag, attributes, stack[-1])
        parent = stack[min(len(stack), DEEPEST) - 1]
        parent.children.append(element)
        if tag in RAW:  # markup means nothing up to the end tag
            if lower is None:
                lower = html.lower() if len(html.lower()) == n else html
            stop = lower.find("</" + tag, pos)
            pos = n if stop < 0 else stop
            if stop >= 0:
                close = html.find(">", stop)
                pos = n if close < 0 else close + 1
            continue
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(element)
    flush()
    return _number(root), [(e.no, e.level, text) for e, text in blocks]


def _number(root: _Element) -> str:
    """Writes the shape and numbers its nodes in preorder; a run of equal siblings shares its numbers."""
    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        todo += e.children
    sizes: dict[int, int] = {}
    for e in reversed(order):  # children before parents
        parts, size, last = [], 1, None
        for c in e.children:
            if c.shape != last:
                parts.append(c.shape)
                size += sizes[id(c)]
                last = c.shape
        e.shape = e.label + ("(" + ",".join(parts) + ")" if parts else "")
        sizes[id(e)] = size
    todo = [(root, 0)]
    while todo:
        e, no = todo.pop()
        e.no, after, last, base = no, no + 1, None, 0
        for c in e.children:
            if c.shape != last:
                base, after, last = after, after + sizes[id(c)], c.shape
            todo.append((c, base))
    return root.shape


class Tree:
    """Nodes in preorder: labels, children by number."""

    def __init__(self, labels: list[str], children: list[list[int]]):
        self.labels, self.children = labels, children

    @classmethod
    def read(cls, shape: str) -> Tree:
        labels, children, stack = [], [], []
        for m in re.finditer(r"([^(),]+)|([()])", shape):
            if m[1]:
                labels.append(m[1])
                children.append([])
                if stack:
                    children[stack[-1]].append(len(labels) - 1)
            elif m[2] == "(":
                stack.append(len(labels) - 1)
            else:
                stack.pop()
        return cls(labels, children)

    def write(self, k: int = 0) -> str:
        inner = ",".join(self.write(c) for c in self.children[k])
        return self.labels[k] + (f"({inner})" if inner else "")


class _Matching:
    """Simple tree matching of two trees; the sizes of subtree pairs are computed once."""

    def __init__(self, a: Tree, b: Tree):
        self.a, self.b, self.known = a, b, {}

    def size(self, x: int, y: int) -> int:
        if self.a.labels[x] != self.b.labels[y]:
            return 0
        if (x, y) not in self.known:
            self.known[x, y] = 1 + int(self._table(x, y)[-1, -1])
        return self.known[x, y]

    def _table(self, x: int, y: int) -> np.ndarray:
        rows, cols = self.a.children[x], self.b.children[y]
        best = np.zeros((len(rows) + 1, len(cols) + 1), np.int64)
        for i, r in enumerate(rows, 1):
            weight = np.array([self.size(r, c) for c in cols], np.int64)
            best[i, 1:] = np.maximum.accumulate(np.maximum(best[i - 1, 1:], best[i - 1, :-1] + weight)) if len(cols) else 0
        return best

    def children(self, x: int, y: int) -> list[tuple[int, int]]:
        """The matched pairs of the children of a matched pair, in order."""
        rows, cols, best = self.a.children[x], self.b.children[y], self._table(x, y)
        i, j, pairs = len(rows), len(cols), []
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                pairs.append((rows[i - 1], cols[j - 1]))
                i, j = i - 1, j - 1
        return pairs[::-1]


def align(template: Tree, page: Tree) -> list[int]:
    """For each node of the page the template's node that it matches, or -1."""
    out = [-1] * len(page.labels)
    m = _Matching(template, page)
    todo = [(0, 0)] if template.labels[0] == page.labels[0] else []
    while todo:
        x, y = todo.pop()
        out[y] = x
        todo += m.children(x, y)
    return out


def merge(template: Tree, page: Tree) -> Tree:
    """The template with the page's unmatched nodes put in after the siblings they follow."""
    m = _Matching(template, page)
    labels, children = [], []

    def copy(tree: Tree, k: int) -> int:
        at = len(labels)
        labels.append(tree.labels[k])
        children.append([])
        children[at] += [copy(tree, c) for c in tree.children[k]]
        return at

    def both(x: int, y: int) -> int:
        at = len(labels)
        labels.append(template.labels[x])
        children.append([])
        pairs = dict(m.children(x, y))
        matched = {c: r for r, c in pairs.items()}
        rest = list(page.children[y])
        for r in template.children[x]:
            if r in pairs:
                while rest and rest[0] not in matched:
                    children[at].append(copy(page, rest.pop(0)))
                children[at].append(both(r, rest.pop(0)))
            else:
                children[at].append(copy(template, r))
        children[at] += [copy(page, c) for c in rest]
        return at

    if template.labels[0] != page.labels[0]:
        return template
    both(0, 0)
    return Tree(labels, children)
