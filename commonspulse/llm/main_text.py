"""Main text of web pages by composite text density.

Each page becomes a tree of elements.  Every node gets the density of its text: characters per tag, weighed down by the
share of characters and tags in links, against the share in the whole body.  The subtree whose children's densities sum
up highest holds the article; on the way from it up to the body the least density is the threshold.  The article element
around it, or else the subtree itself, is taken, with those siblings that reach the threshold; lists of links within that
stay below the threshold are not.

Scripts, styles, controls and the like hold no text.  Menus, forms, and elements whose class, id or role names boilerplate,
are under suspicion only: each is boilerplate unless it is as dense as the body and the page's article stands in it (it holds
a headline, article or main element and more text than stands under no suspicion, or nearly all text of a page without one).

Text: character references decoded, white space as one blank, blocks joined by a blank in page order, nothing else left
out.  Defined cases: a null or empty page, and one without text, give an empty text; repeated rows and null ids are
extracted each; further columns are left out; pages are independent, so any size and order of the table will do.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import pieces, read

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                  "th": {"td", "th"}, "option": {"option"}}
KEEPS = frozenset("ul ol dl table tbody article section div main body td th aside nav footer header".split())
TEXTLESS = frozenset("head script style noscript template button select option textarea input iframe svg canvas object embed audio "
                     "video title".split())
SUSPECT = frozenset("nav footer aside form dialog menu".split())
HEADS = frozenset("h1 article main".split())
LAYOUT = re.compile(r"(?:^|\s)(?:has|with|without|no|is|show|hide)[_-][^\s]*", re.I)
NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|banner|promo(?:tion)?|nav(?:bar|igation)?|menu|"
                   r"breadcrumbs?|sidebar|side|widgets?|footer|masthead|site-header|cookies?|consent|notices?|popup|modal|newsletter|"
                   r"subscribe|share|social|related|recommended|comments?|replies|reply|discussion|disqus|pagination|pager|"
                   r"contentinfo|complementary|search|login|alert)(?:$|[\s_-])", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


class Node:
    """An element: its parts are texts and elements in page order."""

    __slots__ = ("tag", "parent", "parts", "empty", "suspect", "head", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, empty: bool = False, suspect: bool = False) -> None:
        self.tag, self.parent, self.parts, self.empty, self.suspect = tag, parent, [], empty, suspect
        self.head = False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def hidden(tag: str, rest: str) -> bool:
    """Holds no text that is read."""
    return tag in TEXTLESS or any(
        name.lower() == "hidden" or name.lower() == "aria-hidden" and "".join(values).lower() == "true"
        for name, *values in NAMED.findall(rest))


def suspected(tag: str, rest: str, parent: Node) -> bool:
    """Boilerplate by its kind or the names it bears, unless the article stands in it."""
    if tag in SUSPECT:
        return True
    if tag == "header":  # a page's, not an article's
        while parent is not None:
            if parent.tag in ("article", "main"):
                return False
            parent = parent.parent
        return True
    if tag in ("html", "body", "main"):
        return False
    # Names like "has-sidebar" tell the layout of a page, not what an element is.
    return any(name.lower() in ("class", "id", "role") and NAMES.search(LAYOUT.sub(" ", "".join(values)))
               for name, *values in NAMED.findall(rest))


def parse(page: str) -> Node:
    """The page's tree; unclosed and stray tags are mended as browsers do."""
    root = node = Node("#page", None)
    at = 0
    while True:
        token = TOKEN.search(page, at)
        if token is None:
            break
        if token.start() > at:
            node.parts.append(entities.unescape(page[at:token.start()]))
        at = token.end()
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if token["end"]:
            open_node = node
            while open_node.parent is not None and open_node.tag != tag:
                if tag in INLINE and open_node.tag in KEEPS:
                    open_node = root
                    break
                open_node = open_node.parent
            if open_node.parent is not None:
                node = open_node.parent
            continue
        if tag not in INLINE and tag not in VOID or tag == "hr":  # a block ends the paragraph it stands in
            seen = node
            while seen.parent is not None and seen.tag not in KEEPS:
                if seen.tag == "p":
                    node = seen.parent
                    break
                seen = seen.parent
        if tag in CLOSED_BY_SAME:
            seen = node
            while seen.parent is not None and seen.tag not in ("ul", "ol", "dl", "table", "select"):
                if seen.tag in CLOSED_BY_SAME[tag]:
                    node = seen.parent
                    if tag != "tr":
                        break
                seen = seen.parent
        child = Node(tag, node, hidden(tag, token["rest"]), suspected(tag, token["rest"], node))
        node.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            child.parts.append(page[at:end.start()] if tag in ("textarea", "title") else "")
            at = end.end()
        elif tag not in VOID and not (token["rest"].endswith("/") and tag in ("svg", "path", "use")):
            node = child
    if at < len(page):
        node.parts.append(entities.unescape(page[at:]))
    return root


def in_order(root: Node) -> list[Node]:
    """Nodes that count, parents before children."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.empty:
            found.append(node)
            stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return found


def count(node: Node) -> None:
    """Characters and tags of a node, all and in links, from its children's."""
    node.chars = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
    node.tags = node.link_chars = node.link_tags = 0
    node.head = node.tag in HEADS
    for child in node.parts:
        if isinstance(child, Node) and not child.empty:
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.chars if child.tag == "a" else child.link_chars
            node.link_tags += child.link_tags + (child.tag == "a")
            node.head = node.head or child.head


def density(node: Node, share: float) -> float:
    """Composite density of a node; ``share`` is that of characters in links in the body."""
    if not node.chars:
        return 0.0
    tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    base = math.log(node.chars * node.link_chars / max(node.chars - node.link_chars, 1) + share * node.chars + math.e)
    return node.chars / tags * math.log(max(node.chars / links * tags / link_tags, 1)) / math.log(max(base, 1) + 1e-9 + (base <= 1))


def body_of(nodes: list[Node]) -> Node:
    return next((n for n in nodes if n.tag == "body"), nodes[0])


def measure(root: Node) -> list[Node]:
    """Counts, densities and sums of all nodes that count."""
    nodes = in_order(root)
    for node in reversed(nodes):
        count(node)
    body = body_of(nodes)
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        node.density = density(node, share)
    for node in nodes:
        node.total = sum(p.density for p in node.parts if isinstance(p, Node) and not p.empty)
    return nodes


def settle(root: Node) -> None:
    """Empty the suspects in which the article does not stand, innermost first."""
    nodes = measure(root)
    if not any(n.suspect for n in nodes):
        return
    body = body_of(nodes)
    share, least = body.link_chars / max(body.chars, 1), body.density
    # Text and headlines under no suspicion.
    plain, headed, stack = 0, False, [root]
    while stack:
        for part in stack.pop().parts:
            if isinstance(part, str):
                plain += len("".join(part.split()))
            elif not part.empty and not part.suspect:
                headed = headed or part.tag in HEADS
                stack.append(part)
    for node in reversed(nodes):
        count(node)
        if node.suspect:
            home = node.chars > plain if node.head else not headed and node.chars > 10 * plain and node.tag not in ("nav", "menu", "footer")
            node.empty = not home or density(node, share) < least


def chosen(root: Node) -> list[Node]:
    """The subtrees that make up the article, in page order."""
    settle(root)
    nodes = measure(root)
    if not root.chars:
        return []
    best = max(nodes, key=lambda n: (n.total, n.density))
    path = [best]
    while path[-1].parent is not None and path[-1].tag != "body":
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    around = [n for n in path if n.tag in ("article", "main")]
    if around:
        best = around[-1]
    elif best.tag in INLINE or best.tag == "p":  # a sentence's markup is not the article
        best = next((n for n in path if n.tag not in INLINE and n.tag != "p"), best)
    kept = [best]
    if best.parent is not None and best.tag != "body":
        near = [p for p in best.parent.parts if isinstance(p, Node) and not p.empty]
        kept = [p for p in near if p is best or p.chars and p.density >= threshold and (not around or p.tag == best.tag)]
    for node in [n for top in kept for n in in_order(top)]:
        links = node.link_tags >= 3 and 2 * node.link_chars > node.chars
        if links and node.tag not in INLINE and node.density < threshold and node not in kept:
            node.empty = True
    return kept


def text_of(nodes: list[Node]) -> str:
    """Texts in page order; what is not inline sets words apart."""
    out: list[str] = []
    stack: list = list(reversed(nodes))
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.empty:
            out.append(" ")
        else:
            apart = [] if part.tag in INLINE else [" "]
            stack.extend([*apart, *reversed(part.parts), *apart])
    return " ".join("".join(out).split())


def main_text(page: str | None) -> str:
    return text_of(chosen(parse(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()),
            ], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


QUERIES = {"op10_main_text": op10_main_text}
ORACLES: dict[str, str] = {}
