"""Main text of web pages by composite text density.

A page is parsed into a tree in which implied ends (of paragraphs, list items, cells) are made up for. Every node
gets its link-adjusted characters per tag, and the node with the largest sum of its children's densities is chosen.
From it the choice climbs towards the body as long as the parent is at least as dense as the body, whose density is
the threshold; it never leaves the article element that holds it, and takes along page titles (h1) beside its path.
In what is chosen, containers that are mostly links and stay under the threshold are left out.

Elements that never hold an article (menus, footers, sidebars, buttons, dialogs) are taken out. A page header, a
form, or an element whose whole class, id or role says advert, notice, comments and the like, is taken out unless it
holds the article: an article or main element, a title, or nearly all text of the body. A name that only has such a
word in it (``share-price``, ``has-sidebar``) decides nothing.

Defined cases: null, empty or text-free pages give the empty text; unclosed and stray tags, unclosed comments and
truncated pages are read as far as they go; a script or another raw element ends at its own end tag only; ties are
settled by page order; pages are read whole; repeated rows are read each; other columns pass by; an empty table
gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.common import arrow_map, column_of, texts_of

MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>""", re.S)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe template textarea title noembed noframes svg select".split())
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: an opening tag ends an open element of the value, unless an element of the barrier stands between
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BARRIER = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: elements that never hold an article
NEVER = frozenset("nav aside footer button dialog menu head".split())
#: names of parts beside an article, and words that may stand with them in one name
OUT_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice notices notification alert popup modal sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe subscription signup login search pagination pager widget complementary contentinfo".split())
BESIDE = frozenset("site page top bottom left right box block wrapper wrap container bar section area list item items inner outer content slot unit reader readers user users posts articles stories links buttons icons form global primary secondary".split())
SAFE = frozenset("html body article main h1 h2 h3 h4 h5 h6 p".split())
#: share of the body's text from which a part is no part beside the article
MOST = 0.9
LINKS = 0.8
CONTAINERS = frozenset("ul ol dl div section table".split())


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "link_chars", "tags", "link_tags", "links", "density", "total", "beside", "out")

    def __init__(self, tag: str, parent: Node | None, beside: bool) -> None:
        self.tag, self.parent, self.beside = tag, parent, beside
        self.children: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = self.links = 0
        self.density = self.total = 0.0
        self.out = False


def names_beside(attributes: str) -> bool:
    """Whether a whole class, id or role names a part beside an article."""
    for found in NAMES.findall(attributes):
        for name in "".join(found).lower().split():
            words = set(re.split(r"[^a-z]+", name)) - {""}
            if words & OUT_NAMES and words <= OUT_NAMES | BESIDE:
                return True
    return False


def parse(page: str) -> tuple[Node, list[Node]]:
    """The tree, and its nodes in page order."""
    root = Node("html", None, False)
    nodes, stack, at = [root], [root], 0
    opened: dict[str, int] = {}

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            opened[stack.pop().tag] -= 1

    def find(names: tuple[str, ...], barrier: tuple[str, ...]) -> int | None:
        if not any(opened.get(x) for x in names):
            return None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                return k
            if stack[k].tag in barrier:
                return None
        return None

    place = 0
    while m := MARK.search(page, place):
        place = m.end()
        end, tag, attributes = m[1], m[2] and m[2].lower(), m[3]
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = place
        if not tag:
            continue
        if end:
            if opened.get(tag):
                k = find((tag,), ("table",) if tag in INLINE or tag == "p" else ())
                if k is not None:
                    close(k)
            elif tag == "p" or tag == "br":
                stack[-1].children.append(" ")
            continue
        if tag in RAW:
            if not (tag == "svg" and attributes.endswith("/")):
                raw_end = RAW_END[tag].search(page, place)
                at = place = raw_end.end() if raw_end else len(page)
            stack[-1].children.append(" " if tag not in ("script", "style", "noscript", "template") else "")
            continue
        if tag == "body" or tag == "html":
            if opened.get("head"):
                close(next(k for k, x in enumerate(stack) if x.tag == "head"))
            if tag == "html" or opened.get("body"):
                continue
        elif opened.get("head") and tag not in ("meta", "link", "base"):
            close(next(k for k, x in enumerate(stack) if x.tag == "head"))
        if tag in ENDS_P and (k := find(("p",), ("table", "td", "th", "button", "object"))) is not None:
            close(k)
        if tag in ENDS and (k := find(ENDS[tag], BARRIER[tag])) is not None:
            close(k)
        in_article = opened.get("article") or opened.get("main")
        beside = tag == "form" or (tag == "header" and not in_article) or (bool(attributes) and tag not in SAFE and names_beside(attributes))
        up = stack[-1]
        node = Node(tag, up, beside)
        node.out = tag in NEVER
        up.children.append(node)
        nodes.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            opened[tag] = opened.get(tag, 0) + 1
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root, nodes


def count(nodes: list[Node], kept_only: bool) -> None:
    """Characters, tags and links of every node, over all of the tree or without what was taken out."""
    for node in nodes:
        node.chars = node.link_chars = node.tags = node.link_tags = node.links = 0
        node.total = 0.0
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child.strip())
        if node.tag == "a":
            node.link_chars, node.link_tags, node.links = node.chars, max(node.link_tags, 1), 1
        if node.parent is not None and not (kept_only and node.out):
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.link_tags += node.link_tags
            up.links += node.links


def weigh(nodes: list[Node], body: Node) -> None:
    """The density of every node that has text, and the sums of its children's."""
    whole = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, lc, t, lt = node.chars, max(1, node.link_chars), max(1, node.tags), max(1, node.link_tags)
        node.density = 0.0
        if c:
            base = math.log(c * node.link_chars / max(1, c - node.link_chars) + whole * c + math.e)
            ratio = max(c / lc * t / lt, 1.0)
            node.density = c / t * (math.log(ratio) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else math.log(ratio))
        if node.parent is not None and not node.out:
            node.parent.total += node.density


def take_out(nodes: list[Node], body: Node) -> None:
    """Marks what stands beside the article; everything below a marked node counts as marked."""
    holds: set[int] = set()
    for node in nodes:
        if node.tag in ("article", "main") or (node.tag == "h1" and not any(x.tag == "header" for x in _up(node))):
            holds.update(id(x) for x in _up(node))
    never = sum(x.chars for x in nodes if x.tag in NEVER and not any(y.tag in NEVER for y in _up(x)))
    for node in nodes:
        if node.parent is not None and node.parent.out:
            node.out = True
        elif node.beside and id(node) not in holds and node.chars < MOST * (body.chars - never):
            node.out = True


def _up(node: Node) -> Iterator[Node]:
    while (node := node.parent) is not None:
        yield node


def choose(nodes: list[Node]) -> tuple[Node, list[Node], float]:
    """The node of the article, the titles ahead of it, and the threshold: the density of the body as it stood."""
    body = next((x for x in nodes if x.tag == "body"), nodes[0])
    count(nodes, kept_only=False)
    weigh(nodes, body)
    threshold = body.density
    take_out(nodes, body)
    count(nodes, kept_only=True)
    weigh(nodes, body)
    top = max((x for x in nodes if not x.out), key=lambda x: x.total, default=nodes[0])
    path = [top, *_up(top)]
    scope = next((x for x in reversed(path) if x.tag == "article"), None)
    if scope is not None:
        top = scope
    else:
        for node in path[1:]:
            if node is body or node.tag == "html" or node.density < threshold:
                break
            top = node
    titles, below = [], top
    for node in _up(top):
        for child in node.children:
            if child is below:
                break
            if isinstance(child, Node) and child.tag == "h1" and not child.out:
                titles.insert(0, child)
        below = node
    return top, titles, threshold


def written(top: Node, titles: list[Node], threshold: float) -> str:
    """The text of titles and of all that is kept below a node: blocks apart, white space squeezed."""
    parts: list[str] = []
    todo: list[Node | str] = [top, *reversed(titles)]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(html.unescape(x) if "&" in x else x)
            continue
        listing = x is not top and x.tag in CONTAINERS and x.links > 1 and x.link_chars >= LINKS * x.chars and x.density < threshold
        if listing or (x.out and x is not top):
            parts.append(" ")
            continue
        inline = x.tag in INLINE
        if not inline:
            parts.append(" ")
            todo.append(" ")
        todo += reversed(x.children)
    return " ".join("".join(parts).split())


def main_text(page: str) -> str:
    """The article text of one page."""
    if not page:
        return ""
    _, nodes = parse(page)
    return written(*choose(nodes))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page; one pass, no shuffle."""
    source = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).cast("string").alias("__html"))
    types = dict(source.dtypes)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(t) for t in texts_of(batch, "__html")]
            return pa.RecordBatch.from_arrays([column_of(batch, "__id"), column_of(batch, "__url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["__id", "__url", "text", "n_chars"])

        return step

    out = arrow_map(source, make, f"__id {types['__id']}, __url {types['__url']}, text string, n_chars long")
    return out.withColumnRenamed("__id", id_col).withColumnRenamed("__url", url_col)
