"""Main text of web pages by composite text density.

A page becomes a tree of elements. Elements that are boilerplate by their tag, role or a word
of their class or id (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments) are cut out first. For every node

    density = C/T * log_b((C/LC) * (T/LT)),   b = ln(C/(C-LC) * LC + LCbody/Cbody * C + e)

with C characters and T tags below it, LC and LT those in links: characters per
tag, adjusted for links. Each node's *density sum* adds the densities of its
children. The node of the largest density sum is the core of the article. The
least density on its path to the body is the threshold: from the core upwards, the outermost article
or main element is taken if there is one, else the nearest container,
together with its neighbours that reach the threshold and stand in the same parent.

Text: character references are decoded; white space inside a block becomes one
space; blocks (br and block elements end one) are joined by one space in page order.

Defined results: null or empty html, or a page without text, gives the empty string. Broken
markup is read as far as it goes: unclosed elements end with their parent, a
new block ends an open paragraph, a new list item, table cell or row the one before, also where the
element is boilerplate. Repeated rows are each extracted; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.shared import sf_table

# Element names of HTML and words that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg object canvas".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article main section div td body blockquote".split())
HEAD = frozenset("head base basefont bgsound link meta title style script noscript template".split())
# what a start tag ends, where it stands directly around it or with inline elements between
ENDS = {
    **dict.fromkeys(("li", "option"), ()), "dt": ("dd",), "dd": ("dt",), "td": ("th",), "th": ("td",), "tr": ("td", "th"),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ("td", "th", "tr", "thead", "tbody", "tfoot")),
}
BOILERPLATE_TAGS = frozenset("head nav footer aside form script style noscript template iframe textarea title svg object canvas button select dialog menu input".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments respond disqus widget toolbar pagination pager skip".split()
)

# parts of a class that deny what follows or goes before, as in no-sidebar, with-comments, nav-none
DENY_NEXT = frozenset("no not non without with has hide".split())
DENY_LAST = frozenset("none off disabled enabled closed collapsed".split())
OWN_TEXT = frozenset("comment comments respond disqus related recommended recommendations".split())  # these may hold articles of their own

# a quote opens a value only after an equals sign
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total", "cut", "doubt")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children, self.parts = tag, parent, [], []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.cut = parent.cut if parent is not None else None  # the boilerplate element that it stands in
        self.doubt: Doubt | None = parent.doubt if parent is not None else None  # of that element


class Doubt:
    """An element that is boilerplate by a word of its class or id only, and what is cut with it."""

    __slots__ = ("start", "chars", "article")

    def __init__(self, start: int):
        self.start, self.chars, self.article = start, 0, False


def boilerplate_words(value: str) -> set[str]:
    """Boilerplate words of a class or id attribute that are not denied by their neighbours."""
    found = set()
    for token in value.split():
        parts = _WORD.findall(token)
        if DENY_LAST.isdisjoint(parts[-1:]):
            found.update(p for i, p in enumerate(parts) if p in BOILERPLATE_WORDS and (i == 0 or parts[i - 1] not in DENY_NEXT))
    return found


def boilerplate(tag: str, attributes: str, in_article: bool) -> str | None:
    """``sure``, ``word`` (a word of the class or id alone says so, and it may be wrong) or None."""
    if tag in BOILERPLATE_TAGS or (tag == "header" and not in_article):
        return "sure"
    if not attributes or tag in ("body", "html", "article", "main"):
        return None
    kind = None
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "sure"
        if name == "role" and value in BOILERPLATE_ROLES:
            return "sure"
        if name == "style" and "display:none" in value.replace(" ", ""):
            return "sure"
        if name in ("class", "id"):
            words = boilerplate_words(value)
            if not OWN_TEXT.isdisjoint(words):
                return "sure"
            kind = "word" if words else kind
    return kind


def parse(page: str) -> Node:
    """The tree of a page without its boilerplate; text stands in ``parts`` among the children.

    An element that is boilerplate by a word of its class or id stays if it holds an article or main element
    and most of the text outside links: then it is a wrapper of the page.
    """
    spared: set[int] = set()
    while True:
        root, kept, doubts = _tree(page, spared)
        whole = kept + sum(d.chars for d in doubts)
        wrong = {d.start for d in doubts if d.article and 2 * d.chars > whole}
        if not wrong:
            return root
        spared |= wrong  # one element more each time: as many rounds as wrappers around the article


def _tree(page: str, spared: set[int]) -> tuple[Node, int, list[Doubt]]:
    """The tree, the characters outside links that are in it, and the elements in doubt that were cut."""
    root = Node("html", None)
    now, at = root, 0
    articles = links = kept = 0
    doubts: list[Doubt] = []

    def text(piece: str) -> None:
        nonlocal kept
        if not piece:
            return
        if now.cut is None:
            now.parts.append(html.unescape(piece) if "&" in piece else piece)
        if not links:
            chars = len(piece) - sum(map(piece.count, " \n\t"))
            if now.cut is None:
                kept += chars
            elif now.doubt is not None:
                now.doubt.chars += chars

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "a":
            links = 0 if m[1] else 1
        if m[1]:  # an end tag closes down to its element; without one it is ignored
            top = now
            while top is not None and top.tag != tag:
                # no end tag of an inner element closes an article, table cell or body, none of an inline element a block of
                # boilerplate; that of the boilerplate itself closes all in it
                held = top.tag in ("article", "main", "td", "body") and tag not in ("article", "main", "body", "html", "table", "tr")
                held |= top.cut is not None and top.tag in BLOCK and tag not in BLOCK
                top = None if held and not (top.cut is not None and top.cut.tag == tag) else top.parent
            if top is not None and top.parent is not None:
                articles -= top.tag in ("article", "main") and top.cut is None
                now = top.parent
            elif tag in ("body", "html") and now.cut is not None:
                now = now.cut.parent
            continue
        if now.tag == "head" and tag not in HEAD:
            now = now.parent
        if tag in ("html", "body"):
            if tag == "body" and now is root:
                child = Node(tag, now)
                now.parts.append(child), now.children.append(child)
                now = child
            continue
        if tag in BLOCK and tag != "br":
            top = now
            while top is not None and top.tag not in ("p", "button", "select") and top.tag not in CONTAINER:
                top = top.parent
            if top is not None and top.tag == "p":
                now = top.parent
        if tag in ENDS:
            top = now
            while top.parent is not None:
                if top.tag == tag or top.tag in ENDS[tag]:
                    now = top = top.parent
                elif top.tag not in BLOCK and top.tag not in ("button", "select"):
                    top = top.parent
                else:
                    break
        kind = None if now.cut is not None else boilerplate(tag, m[3], articles > 0)
        if kind == "word" and m.start() in spared:
            kind = None
        bad = now.cut is not None or kind is not None
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            # inside boilerplate an element without an end, or ended at once, takes nothing with it
            if now.cut is None or (end and not m[3].endswith("/") and tag not in ("svg", "object", "canvas", "template")):
                at = end.end() if end else len(page)
                if bad or tag != "noscript":
                    now.parts.append(" ")
                    continue
        child = Node(tag, now)
        if bad:  # a node like others, so the same rules end it, but in no tree
            if tag in BLOCK:
                now.parts.append(" ")
            child.cut = child.cut or child
            if kind == "word":
                child.doubt = Doubt(m.start())
                doubts.append(child.doubt)
            elif tag in ("article", "main") and now.doubt is not None:
                now.doubt.article = True
            if tag not in VOID and not m[3].endswith("/"):
                now = child
            continue
        now.parts.append(child), now.children.append(child)
        if tag not in VOID:
            now = child
            articles += tag in ("article", "main")
    text(page[at:])
    return root, kept, doubts


def _measure(root: Node) -> list[Node]:
    """All nodes, parents first, with characters, tags, densities and density sums."""
    nodes, todo = [], [(root, False)]
    linked = {}
    while todo:
        node, inside = todo.pop()
        inside = inside or node.tag == "a"
        linked[id(node)] = inside
        nodes.append(node)
        todo += [(c, inside) for c in reversed(node.children)]
    for node in reversed(nodes):
        own = sum(len(p) - p.count(" ") for p in node.parts if isinstance(p, str))
        node.chars += own
        if linked[id(node)]:
            node.link_chars += own
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.link_tags += node.link_tags + (node.tag == "a")
    body = next((n for n in nodes if n.tag == "body"), root)
    part = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - lc) * lc + part * c + math.e)
            node.density = c / t * math.log(max(1.0, c / max(1, lc) * t / lt)) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else c / t
    for node in nodes:
        node.total = sum(c.density for c in node.children)
    return nodes


def _flat(node: Node, out: list[str]) -> None:
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x.tag in BLOCK:
            out.append(" ")
            todo.append(" ")
        todo += reversed(x.parts)


def main_text(page: str | None) -> str:
    """The article of one page."""
    if not page:
        return ""
    root = parse(page)
    nodes = _measure(root)
    if not root.chars:
        return ""
    core = max(nodes, key=lambda n: n.total)
    if not core.total:
        core = root
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    whole = [n for n in path if n.tag in ("article", "main")]
    if whole:
        chosen = [whole[-1]]
    else:
        top = next((n for n in path if n.tag in CONTAINER), root)
        up = top.parent
        chosen = [top] if up is None else [n for n in up.children if n is top or (n.density >= threshold and n.tag in BLOCK)]
        if up is not None and up.tag == "body" and top.tag == "body":
            chosen = [top]
    out: list[str] = []
    for n in chosen:
        _flat(n, out)
        out.append(" ")
    return " ".join("".join(out).split())


def _extract(batches):
    for batch in batches:
        text = [main_text(h) for h in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    pages = pages.selectExpr("cast(page_id as long) page_id", "url", "html")
    return pages.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op8_text_density(spark, sf_dir: str) -> DataFrame:
    return extract(sf_table(spark, sf_dir, "pages"))
