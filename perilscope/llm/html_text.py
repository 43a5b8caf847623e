"""Main text of web pages by composite text density.

A page becomes a tree of elements with their text. For every element: characters C and tags T below it (1 at least), and the
parts of both inside links, LC and LT. The density is characters per tag, adjusted for links:

    C / T x log(C x T / (LC x LT)) to the base ln(C x LC / (C - LC) + LC_body x C / C_body + e)

The density sum of an element is the sum over its children. The element with the greatest sum marks the page; the least
density on its path from the body is the threshold. The greatest sum among the elements at or above the threshold is the main
subtree. Names take no part in that choice: menus, headers and sidebars are measured like any other element.

The chosen subtree grows over an enclosing article or main element. Of what it holds, parts are left out that the markup calls
something else: menus, headers, footers, sidebars, notices, adverts, forms and comments. A name alone never leaves out an article or main
element, what holds the main element, or what holds most of the body's text while no article or main stands outside it.

Text has its character references decoded, white space in a block made one space and trimmed; blocks are joined by one space in
page order. Rows are independent: Arrow batches, no shuffle, memory for one page at a time.

Defined results: NULL or empty pages give the empty text, as do pages without a body text; unclosed and stray tags are
taken as browsers roughly do; unclosed comments, scripts and styles run to the end of the page. Repeated rows are treated
alike. Other columns are carried along; input columns called text or n_chars are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Element kinds -----------------------------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
# What is no text of the page, and what is, but stands beside an article.
DROPPED = frozenset("head script style noscript template iframe object embed button select textarea canvas svg math audio video map".split())
ASIDE = frozenset("nav header footer aside form option input label dialog menu".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = frozenset("ul ol dl table article section div body html main".split())

# What may stand in an open head; anything else begins the body.
HEAD = frozenset("base basefont bgsound link meta title style script noscript template noframes".split())
ARTICLES = frozenset(("article", "main"))

# Names in class, id or role of a part beside the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs header masthead footer colophon sidebar complementary contentinfo aside cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login comment "
    "comments commentlist disqus replies respond related recommended share sharing social toolbar search pagination pager "
    "copyright legal disclaimer widget widgets hidden".split()
)
# Words that go with these in one name (top-menu, comment-list); with any other word (has-sidebar, search-results) it names
# something else. Single letters go with them too.
PLACES = frozenset(
    "top bottom left right upper lower main primary secondary site page global local mobile desktop sticky fixed floating bar "
    "box boxes block area section wrap wrapper container holder inner outer list item items link links button buttons icon icons "
    "group panel pane region row col column slot unit form module component trail thread posts js wp visually".split()
)
# Quantifiers that never give back keep a page with stray quotes from being searched again and again.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|</\s*([a-zA-Z][^\s/>]*+)[^>]*+>?"
    r"|<([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>])*+)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I | re.S)
WORDS = re.compile(r"[a-z]+")
WHITE = re.compile(r"\s+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    __slots__ = ("tag", "parent", "parts", "dropped", "beside", "named", "own", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Element | None, dropped: bool, named: bool = False):
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, named
        self.beside = tag in ASIDE
        self.parts: list[Element | str] = []
        self.own = self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def is_beside(name: str) -> bool:
    """Whether a whole class name, id or role is that of a part beside the article."""
    found = WORDS.findall(CAMEL.sub(" ", name).lower())
    return not BESIDE.isdisjoint(found) and all(w in BESIDE or w in PLACES or len(w) == 1 for w in found)


def marked(attributes: str) -> tuple[bool, bool]:
    """Whether the element is hidden, and whether class, id or role name a part beside the article."""
    named = False
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = next((v for v in values if v), ""), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, named
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True, named
        elif name in ("class", "id", "role") and any(map(is_beside, value.split())):
            named = True
    return False, named


def parse(html: str) -> Element:
    """The tree of a page; its root is the body."""
    root = at = Element("body", None, False)
    position, size, begun = 0, len(html), False
    while position < size:
        match = TOKEN.search(html, position)
        text = html[position : match.start() if match else size]
        if at.tag == "head" and text.strip():
            at, begun = root, True
        if text:
            at.parts.append(text)
        if match is None:
            break
        position = match.end()
        if match[1]:
            at = closed(at, match[1].lower())
            continue
        if not match[2]:
            continue
        tag, attributes = match[2].lower(), match[3] or ""
        if at.tag == "head" and tag not in HEAD:
            at = root if tag not in ("html", "head") else at
        begun = begun or tag not in HEAD and tag not in ("html", "head")
        if tag in ("html", "body") or (tag == "head" and (begun or at.tag == "head")):
            continue
        if tag in CLOSES_P:
            at = without_open(at, {"p"})
        if tag in SIBLINGS:
            at = without_open(at, SIBLINGS[tag])
        hidden, named = marked(attributes) if attributes else (False, False)
        child = Element(tag, at, hidden or tag in DROPPED, named and tag not in ARTICLES)
        at.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, position)
            position = end.end() if end else size
            if not end and tag in ("title", "textarea"):
                position = match.end()
        elif tag not in VOID and not attributes.endswith("/"):
            at = child
    return root


def closed(at: Element, tag: str) -> Element:
    """Where the tree goes on after an end tag; stray end tags change nothing."""
    node: Element | None = at
    while node is not None and node.tag != tag:
        if tag in INLINE and node.tag in SCOPES:
            return at
        node = node.parent
    return at if node is None or node.parent is None else node.parent


def without_open(at: Element, tags: set[str]) -> Element:
    """Close the nearest open element of these, if nothing scopes it."""
    node: Element | None = at
    while node is not None and node.tag not in SCOPES:
        if node.tag in tags:
            return node.parent or at
        node = node.parent
    return at


def inside(node: Element, aside: bool = True) -> list[Element]:
    """The elements of a node that hold text of the page; without ``aside``, also of the article."""
    return [p for p in node.parts if isinstance(p, Element) and not p.dropped and (aside or not p.beside)]


def in_order(root: Element, aside: bool = True) -> list[Element]:
    """All elements, parents first; no recursion, so depth doesn't matter."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(reversed(inside(node, aside)))
    return found


def settle(root: Element) -> Element:
    """Decide which elements with a name from beside the article are left out."""
    for node in in_order(root):
        node.own = sum(len(WHITE.sub("", p)) for p in node.parts if isinstance(p, str))
    nodes = in_order(root, aside=False)
    for node in reversed(nodes):
        node.chars = node.own + sum(p.chars for p in inside(node, aside=False))
    if not any(node.named for node in nodes):
        return root
    # Articles outside of any such element: in all, and on the path to each node.
    apart, on_path, articles, around_main = {root: False}, {root: 0}, 0, set()
    for node in nodes[1:]:
        apart[node] = node.named or apart[node.parent]
        counts = node.tag in ARTICLES and node.chars > 0 and not apart[node]
        on_path[node] = on_path[node.parent] + counts
        articles += counts
        if node.tag == "main" and node.chars:
            above = node.parent
            while above is not None and above not in around_main:
                around_main.add(above)
                above = above.parent
    for node in nodes:
        most = 2 * node.chars > root.chars and articles == on_path[node]
        node.beside = node.beside or node.named and not most and node not in around_main
    return root


def measure(root: Element) -> list[Element]:
    """Set counts, densities and density sums of all elements, whatever they are called; the elements, parents first."""
    nodes = in_order(root)
    for node in reversed(nodes):
        node.chars = node.own
        for child in inside(node):
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.link_chars
            node.link_tags += child.link_tags + (child.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    share = root.link_chars / max(root.chars, 1)
    for node in reversed(nodes):
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c * node.link_chars / max(c - node.link_chars, 1) + share * c + math.e)
        # The logarithm of the base is 0 without any link; the limit below keeps it from dividing by zero.
        node.density = c / t * math.log(max(c * t / (lc * lt), 1.0)) / max(math.log(base), 1e-3)
        node.total = sum(p.density for p in inside(node))
    return nodes


def main_part(root: Element) -> Element:
    nodes = measure(root)
    best = max(nodes, key=lambda n: n.total)
    if best.total <= 0:
        return root
    path, node = [], best
    while node is not None:
        path.append(node.density)
        node = node.parent
    threshold = min(path)
    best = max((n for n in nodes if n.density >= threshold), key=lambda n: n.total, default=best)
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            best = node
        node = node.parent
    return best


def text_of(root: Element) -> str:
    """The blocks of a subtree, without what stands beside the article."""
    blocks, current = [], []
    stack: list[Element | str | None] = [root]

    def end_block() -> None:
        block = " ".join(unescape("".join(current)).split())
        current.clear()
        if block:
            blocks.append(block)

    while stack:
        part = stack.pop()
        if part is None:
            end_block()
        elif isinstance(part, str):
            current.append(part)
        elif part is root or not (part.dropped or part.beside):
            if part.tag not in INLINE:
                end_block()
                stack.append(None)
            stack.extend(reversed(part.parts))
    end_block()
    return " ".join(blocks)


def main_text(html: str | None) -> str:
    return text_of(main_part(settle(parse(html)))) if html else ""


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add text (main text, empty if there is none) and n_chars (its code points); html itself is left out."""

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None)

    found = F.pandas_udf(texts, "string")
    others = [F.col(f"`{name}`") for name in pages.columns if name not in (html, "text", "n_chars")]
    rows = pages.select(*others, found(F.col(html)).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
