"""Main text of web pages by composite text density (Sun, Song and Liao, 2011).

Each node of a page's tree has a density: characters per tag below it, adjusted for the share of characters that are
link text. A node's sum is that of its children's densities, and the node with the largest sum holds the main text. The
least density on the way from the body to that node is the threshold: other parts of the page that reach it as a whole
are main text too, which brings back a heading beside the column of text. Parts that are navigation, notices, adverts,
forms or comments by their tag, role, class or id are taken out before.

Defined results: null or empty html, and a page without text, give an empty text; broken markup is read as browsers
read it (implied end tags, quoted ends of tags, unclosed elements and comments); repeated rows come out alike; an empty
table gives no rows; equal sums go to the outer, earlier node; nodes are walked without recursion, so depth and length
have no limit but memory. Further columns are kept out.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .texts import blocks, pick

# Fixed values of HTML: elements without content, with raw content, that are blocks, and that end an open paragraph's kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
ENDS_P = BLOCKS - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead title tr".split())

#: Elements that are never main text.
ASIDE = frozenset("nav footer aside form menu dialog button select datalist search object audio video canvas map head".split())
#: The same by role, and by a word of the class or id.
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
WORDS = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager header masthead topbar toolbar footer colophon sidebar sidenav aside widget "
    "widgets related recommended recommendations trending popular share sharing social follow ad ads advert adverts advertisement advertising adsense adbox banner "
    "promo promotion promoted sponsor sponsored sponsors cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login signin register form search comment comments commentlist respond reply replies disqus discussion feedback tags copyright legal "
    "disclaimer skip".split()
)
#: Words that make a name tell how a page is laid out, such as has-sidebar.
_HOW = frozenset("has with no without layout enabled disabled".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold the article whatever their class says.
_WHOLE = frozenset("article main body html".split())

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Node:
    tag: str
    parent: int
    first: int
    aside: bool = False
    children: list[int] = field(default_factory=list)
    last: int = 0
    chars: int = 0
    links: int = 0
    tags: int = 0
    link_tags: int = 0
    density: float = 0.0
    total: float = 0.0


def _is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ASIDE or (tag == "header" and not in_article):
        return True
    if not attributes or tag in _WHOLE:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and not ROLES.isdisjoint(value.lower().split()):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id"):
            told = [{w.lower() for w in _NAME.findall(x)} for x in value.split()]
            named = set().union(*[t & WORDS for t in told if t.isdisjoint(_HOW)])
            # The header of an article holds its title.
            if named and not (named <= {"header"} and (in_article or tag in HEADINGS)):
                return True
    return False


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order, and the pieces of text with the node that holds each. A node's pieces are ``first:last``.

    Pieces of the raw elements are left out; a block's begin or end and ``br`` are pieces without a text of their own.
    """
    nodes, texts = [Node("html", -1, 0)], []
    open_, names, articles = [0], ["html"], 0
    at, size = 0, len(html)

    def close(to: int) -> None:
        nonlocal articles
        while len(open_) > to:
            node = nodes[open_.pop()]
            articles -= names.pop() in ("article", "main")
            if node.tag in BLOCKS:
                texts.append((node.parent, "\n"))
            node.last = len(texts)

    def find(wanted, stop) -> int:
        for i in range(len(names) - 1, 0, -1):
            if names[i] in wanted:
                return i
            if names[i] in stop:
                return 0
        return 0

    while at < size:
        less = html.find("<", at)
        token = None
        if less >= 0:
            token = _TOKEN.match(html, less)
        if less < 0 or token is None:
            upto = size if less < 0 else less + 1
            texts.append((open_[-1], html[at:upto]))
            at = upto
            continue
        if less > at:
            texts.append((open_[-1], html[at:less]))
        at = token.end()
        if token[2] is None:
            continue
        tag, attributes = token[2].lower(), token[3]
        if token[1]:
            i = find({tag}, {"table"} if tag not in BLOCKS else ())
            if i:
                close(i)
            elif tag in ("p", "br"):
                texts.append((open_[-1], "\n" if tag == "p" else " "))
            continue
        if tag in ENDS_P:
            i = find({"p"}, {"table", "button", "td", "th", "caption"})
            if i:
                close(i)
        if tag in CLOSES:
            wanted, stop = CLOSES[tag]
            while (i := find(wanted, stop)) and i:
                close(i)
        if tag == "br":
            texts.append((open_[-1], " "))
        elif tag == "hr":
            texts.append((open_[-1], "\n"))
        if tag in ("html", "body") and tag in names and tag != "body":
            continue
        if tag in BLOCKS and tag != "hr":
            texts.append((open_[-1], "\n"))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else size
            continue
        number = len(nodes)
        nodes.append(Node(tag, open_[-1], len(texts), _is_aside(tag, attributes, articles > 0)))
        nodes[open_[-1]].children.append(number)
        if tag in VOID or (attributes.endswith("/") and tag not in BLOCKS and tag not in ("a", "b", "i", "span", "em", "strong")):
            nodes[number].last = len(texts)
            continue
        open_.append(number)
        names.append(tag)
        articles += tag in ("article", "main")
    close(1)
    nodes[0].last = len(texts)
    return nodes, texts


def measure(nodes: list[Node], texts: list[tuple[int, str]]) -> list[str]:
    """Fills in densities, with what is aside left out, and gives the decoded pieces."""
    holds = [node.tag in ("article", "main") for node in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
    for i, node in enumerate(nodes[1:], 1):
        # A wrapper that holds an article, whatever its class, is no part beside it.
        node.aside = nodes[node.parent].aside or (node.aside and not holds[i])
    shown = ["" if nodes[n].aside else entities.unescape(t) if "&" in t else t for n, t in texts]
    in_link = [False] * len(nodes)
    for i, node in enumerate(nodes):
        in_link[i] = node.tag == "a" or (node.parent >= 0 and in_link[node.parent])
    for (n, _), text in zip(texts, shown):
        many = len("".join(text.split()))
        nodes[n].chars += many
        nodes[n].links += many if in_link[n] else 0
    for node in reversed(nodes[1:]):
        above = nodes[node.parent]
        if not node.aside:
            above.chars += node.chars
            above.links += node.links
            above.tags += node.tags + 1
            above.link_tags += node.link_tags + (node.tag == "a")
    body = nodes[0]
    share = body.links / body.chars if body.chars else 0.0
    for node in nodes:
        if node.chars and not node.aside:
            tags, links, link_tags = max(node.tags, 1), max(node.links, 1), max(node.link_tags, 1)
            plain = max(node.chars - node.links, 1)
            base = math.log(node.chars / plain * node.links + share * node.chars + math.e)
            ratio = node.chars / links * tags / link_tags
            node.density = node.chars / tags * (math.log(ratio) / math.log(base) if base > 1 and ratio > 1 else math.log(ratio + 1) if ratio > 0 else 0.0)
    for node in nodes[1:]:
        # Inline elements count as tags of their block; a block without blocks inside is no container.
        nodes[node.parent].total += node.density if node.tag in BLOCKS else 0.0
    return shown


def select(nodes: list[Node]) -> list[int]:
    """Nodes of the main text in page order, none inside another.

    The node with the largest sum stands for the ``article`` around it if there is one. Beside the way from the body
    to it, parts as dense as the least dense node on the way are main text, and so are headings.
    """
    best = max(range(len(nodes)), key=lambda i: (nodes[i].total, -i))
    path, threshold, n = set(), math.inf, best
    while n >= 0:
        path.add(n)
        threshold = min(threshold, nodes[n].density)
        if nodes[n].tag == "article":
            best = n
        n = nodes[n].parent
    chosen, todo = [], [0]
    while todo:
        n = todo.pop()
        node = nodes[n]
        if n == best or (n not in path and node.chars and (node.density >= threshold or node.tag in HEADINGS)):
            chosen.append(n)
        elif n in path:
            todo.extend(reversed(node.children))
    return chosen


def extract(html: str | None) -> str:
    """The main text: blocks in page order, one a line."""
    if not html:
        return ""
    nodes, texts = parse(html)
    shown = measure(nodes, texts)
    lines = []
    for n in select(nodes):
        block: list[str] = []
        for i in range(nodes[n].first, nodes[n].last):
            if texts[i][1] == "\n":
                lines.append("".join(block))
                block = []
            else:
                block.append(shown[i])
        lines.append("".join(block))
    return "\n".join(line for line in (" ".join(x.split()) for x in lines) if line)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "html"):
                texts = [extract(h) for h in block.column(2).to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.record_batch([block.column(0), block.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    page_id = pages.schema["page_id"].dataType.simpleString()
    return pick(pages, "page_id", "url", "html").mapInArrow(run, f"page_id {page_id}, url string, text string, n_chars long")
