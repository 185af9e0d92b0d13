"""Main text of web pages by composite text density.

A page becomes a tree of its elements. Menus, headers, footers, sidebars, notices, adverts, forms,
scripts and reader comments are taken out by what they are: their tag, role, or a word of their class or
id. A form, and an element with such a word, stays if it turns out to hold the page's text: a wrapper may be
called "no-sidebar". Comments under any name are told by their structure: what follows the page's article beside it
and repeats blocks of one shape. An article's own header stays. For every node left, the density is its characters per tag, adjusted by how much of them is link
text; a node's density sum adds up its children's. The lowest density on the way from the body to
the densest region is the threshold; among the nodes that reach it, the one with the largest density
sum holds the text, and all of its blocks are taken, after the page's only first heading if that stands outside.

Defined results: a null or empty page, and one without any text, gives an empty text; a page without
tags is text as a whole; unclosed, crossed and unknown tags are read as a browser would; an empty
table gives an empty table.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import table
from vitrine.llm.letters import pieces_of

# Fixed by the HTML standard: elements without content, with raw text, and those that end a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table"
    " tbody td tfoot th thead title tr ul".split()
)
# An open element of the key ends where one of its set begins.
ENDS = {
    "p": BLOCK - {"br", "body", "html", "head", "title", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "option", "optgroup"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "thead", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "thead", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "thead", "tfoot"}),
    "option": frozenset({"option", "optgroup"}),
    "head": frozenset({"body"}),
}
# Where looking for the element to end stops.
SCOPE = frozenset({"table", "td", "th", "ul", "ol", "dl", "div", "section", "article", "body", "html", "blockquote"})

OUT_TAGS = RAW | frozenset("head nav header footer aside button select input dialog object canvas audio video menu search".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion promotions"
    " nav navbar navigation menu menus menubar breadcrumb breadcrumbs pagination pager toolbar topbar"
    " header masthead footer sidebar sidebars aside rail widget widgets related recommended recommendations"
    " comment comments disqus respond replies"
    " cookie cookies consent gdpr notice notices popup modal overlay alert newsletter subscribe subscription signup login"
    " share sharing social search form copyright skip".split()
)
READER_WORDS = frozenset("comment comments disqus respond replies discussion discussions feedback reactions responses guestbook".split())  # what they name is often longer than the article
REPEATED = frozenset("article div li section dd blockquote".split())  # what a reader's comment is
KEPT_TAGS = frozenset("html body main article".split())  # never out by a word of their class or id

# A tag up to its end; a quoted value may hold ">". Nothing is tried twice, so time stays linear.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?>[^>=]|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTES = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Za-z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


ENOUGH = 0.1  # of the largest density sum, or of the unlinked text, for a region to count as text of the page
IN, OUT, DOUBT, READERS = 0, 1, 2, 3  # an element is in, is out, or is out unless it holds the page's text


class Node:
    __slots__ = ("tag", "shape", "parent", "out", "doubt", "items", "chars", "link_chars", "tags", "link_tags", "density", "total", "ender")

    def __init__(self, tag: str, parent: Node | None, out: bool, doubt: int = IN, shape: str = ""):
        self.tag, self.parent, self.out, self.doubt, self.shape = tag, parent, out, doubt, shape
        self.items: list[Node | str] = []  # children and pieces of text in page order
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0
        # The innermost open element, this one or around it, that another element's begin may end.
        self.ender: Node | None = self if tag in ENDS else None if tag in SCOPE or parent is None else parent.ender


def _kind(tag: str, attributes: str, in_article: bool) -> int:
    """Is this element no part of an article, by its tag, role, class or id?"""
    if tag in OUT_TAGS and not (tag == "header" and in_article):
        return OUT
    kind = DOUBT if tag == "form" else IN
    if not attributes:
        return kind
    for name, value in _ATTRIBUTES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            if value.lower() in OUT_ROLES:
                return OUT
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            return OUT
        elif name in ("class", "id") and tag not in KEPT_TAGS and not (tag == "header" and in_article):
            words = {w.lower() for w in _WORDS.findall(value)}
            kind = max(kind, READERS if words & READER_WORDS else DOUBT if words & OUT_WORDS else IN)
    return kind


def _shape(attributes: str) -> str:
    """The class of an element, as it is written."""
    return next((value.strip("\"'") for name, value in _ATTRIBUTES.findall(attributes) if name.lower() == "class"), "") if attributes else ""


def parse(page: str) -> Node:
    """The page's tree. Text in elements that are surely out is not kept."""
    root = node = Node("html", None, False)
    opened: dict[str, int] = {}  # how many elements of a tag are open, the root apart
    endless: set[str] = set()  # raw elements whose end tag does not come any more
    at, start, size = 0, 0, len(page)  # text since `at`, looking for a tag from `start`
    while True:
        start = page.find("<", start)
        mark = page[start + 1 : start + 2] if start >= 0 else ""
        if start >= 0 and not (mark.isalpha() and mark.isascii() or mark and mark in "/!?"):
            start += 1
            continue
        if not node.out and (text := page[at : start if start >= 0 else size]):
            node.items.append(text)
        if start < 0:
            return root
        if mark in "!?":
            if page.startswith("<!--", start):
                end = _COMMENT_END.search(page, start + 2)
                at = end.end() if end else size
            else:
                at = page.find(">", start) + 1 or size
            start = at
            continue
        tag = _TAG.match(page, start)
        if tag is None:
            if mark != "/":
                return root  # a tag that the page's end cuts off
            at = start = page.find(">", start) + 1 or size
            continue
        at = start = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if opened.get(name):
                while node.tag != name:
                    opened[node.tag] -= 1
                    node = node.parent
                opened[name] -= 1
                node = node.parent
            elif name == "p":
                node.items.append(Node("br", node, True))
            continue
        if name == "html":
            continue
        ended = _ended_by(node, name)
        while ended is not None and node is not ended.parent:
            opened[node.tag] -= 1
            node = node.parent
        kind = _kind(name, tag[3], bool(opened.get("article")))
        child = Node(name, node, node.out or kind == OUT, kind, _shape(tag[3]) if name in REPEATED else "")
        if not node.out:
            node.items.append(child)
        if name in VOID or name not in BLOCK and tag[3].endswith("/"):
            continue
        if name in RAW and name not in endless:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            if end is not None:
                at = start = end.end()
            elif name in ("script", "style", "textarea", "title", "xmp"):
                return root
            else:
                endless.add(name)
            continue
        node = child
        opened[name] = opened.get(name, 0) + 1


def _ended_by(node: Node, name: str) -> Node | None:
    """The open element that the begin of another one ends."""
    ender = node.ender
    while ender is not None:
        if name in ENDS[ender.tag]:
            return ender
        if ender.tag in SCOPE or ender.parent is None:
            return None
        ender = ender.parent.ender
    return None


def _in_order(root: Node) -> list[Node]:
    """Every node that is not out, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.items) if isinstance(x, Node) and not x.out]
    return out


def _settle(root: Node) -> None:
    """Takes out the elements in doubt that do not hold the page's text.

    What stays holds most of the unlinked text; or some of it, and the page's main element, first heading or
    longest article. Reader comments may well be most of the text, and articles themselves: they stay only
    with a main element or first heading, or where there is next to nothing else.
    """
    nodes = _in_order(root)
    if not any(n.doubt > OUT for n in nodes):
        return
    plain: dict[Node, int] = {}
    leading: dict[Node, bool] = {}
    for node in reversed(nodes):
        inner = [x for x in node.items if isinstance(x, Node) and not x.out]
        own = sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str))
        plain[node] = 0 if node.tag == "a" else own + sum(plain[x] for x in inner)
        leading[node] = node.tag in ("main", "h1") or any(leading[x] for x in inner)
    # Articles among comments are comments.
    among: dict[Node, bool] = {}
    for node in nodes:
        among[node] = not leading[node] and node.doubt == READERS or node.parent is not None and among[node.parent]
    articles = [n for n in nodes if n.tag == "article" and not among[n]]
    around = set(_way_up(max(articles, key=plain.__getitem__))) if articles else set()
    whole = plain[root]
    for node in nodes:
        if node.doubt > OUT:
            most = 1 - ENOUGH if node.doubt == READERS else 0.5
            holds = leading[node] or node in around
            node.out = not (plain[node] > most * whole or holds and plain[node] > ENOUGH * whole)


def _leave_readers(nodes: list[Node]) -> None:
    """Takes out what follows the page's article, beside it or around it, and repeats blocks of one shape: comments, or
    teasers of other articles. Without an article element, or with several on one level, nothing is known to follow."""
    size: dict[Node, int] = {}
    for node in reversed(nodes):
        inner = (x for x in node.items if isinstance(x, Node) and not x.out)
        size[node] = sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str)) + sum(size[x] for x in inner)
    articles = [n for n in nodes if n.tag == "article"]
    if not articles:
        return
    own = max(articles, key=size.__getitem__)
    if 2 * size[own] < max((size[n] for n in articles if n is not own and n.parent is own.parent), default=0) * 3:
        return
    around = _way_up(own)
    for node, parent in zip(around, around[1:]):
        if any(isinstance(x, Node) and x is not node and x.tag == "article" and not x.out for x in parent.items):
            continue  # a list of articles
        later = parent.items[parent.items.index(node) + 1 :]
        for block in later:
            if isinstance(block, Node) and not block.out and _repeats(block):
                block.out = True


def _repeats(block: Node) -> bool:
    """Has this element, or one within it, at least two children of one shape that hold blocks or text of their own?"""
    todo = [block]
    while todo:
        node = todo.pop()
        inner = [x for x in node.items if isinstance(x, Node) and not x.out]
        shapes = [(x.tag, x.shape) for x in inner if x.tag in REPEATED and any(isinstance(y, Node) for y in x.items)]
        if len(shapes) > len(set(shapes)):
            return True
        todo += inner
    return False


def _weigh(nodes: list[Node]) -> Node:
    """Counts, densities and density sums of all nodes; returns the body."""
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    for node in reversed(nodes):
        for item in node.items:
            if isinstance(item, str):
                node.chars += len(" ".join(item.split()))
            elif not item.out:
                node.chars += item.chars
                node.link_chars += item.link_chars
                node.tags += item.tags + 1
                node.link_tags += item.link_tags + (item.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    share = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        if node.chars:
            c, t = node.chars, max(1, node.tags)
            lc, lt = max(1, node.link_chars), max(1, node.link_tags)
            base = math.log(c / max(1, c - node.link_chars) * node.link_chars + share * c + math.e)
            node.density = c / t * math.log(max(1.0, c / lc * t / lt)) / base
        node.total = sum(x.density for x in node.items if isinstance(x, Node) and not x.out) or node.density
    return body


def main_node(root: Node) -> Node:
    """The node that holds the page's text.

    The lowest density between the node of the largest density sum and the body is the threshold. Every
    node that reaches it marks the largest density sum below it; the innermost node around the marks that
    weigh enough is the one, widened to the page's own article element if it lies in one.
    """
    _settle(root)
    _leave_readers(_in_order(root))
    nodes = _in_order(root)
    body = _weigh(nodes)
    densest = max(nodes, key=lambda n: n.total)
    threshold, node = densest.density, densest
    while node is not None and node is not body:
        node = node.parent
        threshold = min(threshold, node.density) if node is not None else threshold
    largest: dict[Node, Node] = {}
    for node in reversed(nodes):
        below = [largest[x] for x in node.items if isinstance(x, Node) and not x.out]
        largest[node] = max([node, *below], key=lambda n: n.total)
    marks = {largest[n] for n in nodes if n.density >= threshold}
    # The innermost node around all that count: every node is climbed over once.
    path = _way_up(densest)
    place = {n: i for i, n in enumerate(path)}
    highest, seen = 0, set()
    for mark in marks:
        if mark.total >= ENOUGH * densest.total:
            while mark not in place and mark not in seen:
                seen.add(mark)
                mark = mark.parent
            highest = max(highest, place.get(mark, 0))
    return next((n for n in reversed(path[highest:]) if n.tag in ("article", "main")), path[highest])


def _way_up(node: Node | None) -> list[Node]:
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out


def blocks(root: Node) -> list[str]:
    """The texts of the blocks below a node, references decoded, white space made single."""
    out: list[str] = []
    part: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(part)).split())
        part.clear()
        if text:
            out.append(text)

    todo: list[Node | str | None] = [root]
    while todo:
        item = todo.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            part.append(item)
        elif item.out and item is not root:
            if item.tag in BLOCK:
                close()
        else:
            if item.tag in BLOCK:
                close()
                todo.append(None)
            todo += reversed(item.items)
    close()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    node = main_node(root)
    return " ".join([*_headline(root, node), *blocks(node)])


def _headline(root: Node, node: Node) -> list[str]:
    """The blocks of the page's only first heading, if it stands before `node` and not in it."""
    nodes = _in_order(root)
    first = [n for n in nodes if n.tag == "h1"]
    if len(first) != 1 or node in _way_up(first[0]) or nodes.index(first[0]) > nodes.index(node):
        return []
    return blocks(first[0])


def with_main_text(pages: DataFrame, page: str = "html", carried: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The carried columns and `text`. Narrow: pages stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            texts = pa.array([main_text(x.as_py()) for x in batch.column("__page")], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), texts], [*carried, "text"])

    some = pages.select(*carried, F.col(page).alias("__page"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.schema.fields if f.name in carried)
    return some.mapInArrow(run, f"{kinds}, text string")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = with_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
