"""Main text of web pages by consensus host paths.

Every page is read into a tree of elements and blocks of text. Each container gets a score: the text directly in its
blocks, less text in links, passed on to the containers around it at a discount, and weighted by what its tag and class
names say. A page gives its vote, in shares, to the generalised paths (tags and classes, digits made equal, no
positions) of its best containers. Votes are summed per host, and the paths with a tenth of a host's votes or more win.
Pages are then read again: the text is that of the host's first winning path that the page has, or of a
winning path inside it that the page itself scores best. A page without any winning path uses its own best container.

Within the containers taken, everything that is no article goes: menus, headers (their headings stay when the
container holds them), footers, sidebars, notices, adverts, forms, scripts, styles and reader comments, told by
tag, role, class or id, as well as lists of links. Nothing else is left out. References are decoded, white space
inside a block becomes one space, blocks are joined by a line feed.

A null html is an empty page with an empty text; pages without a host share an empty one. Rows are treated one by one, so
repeated rows and ids stay. Paths of equal votes are taken in order of their names. Unclosed and misplaced
tags, cut-off pages and very long or deep pages are read as they are, one page in memory at a time. Empty
tables give no rows. Further columns do not matter.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import common

LEAST_SHARE = 0.1  # of a host's votes, so a host has at most ten winning paths
VOTES = 1000  # shares of a page's vote are whole numbers, so that sums do not depend on their order
CANDIDATES = 3  # containers among which a page shares its vote
DISCOUNT = 0.6
LONGEST_PATH = 400  # characters; what is longer is named by its hash

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|title|textarea|iframe|noembed|noframes|xmp)\b[^>]*>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?)*+)>"
    r"|<[!?][^>]*(?:>|\Z)|</(?:[^a-z][^>]*)?(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)

VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
CONTAINERS = frozenset("body div section article main td center".split())
BLOCKS = CONTAINERS | frozenset(
    "html head p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption pre blockquote figure figcaption hr "
    "address details summary fieldset legend header footer nav aside form hgroup menu dialog option select".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl table menu".split())
# A start tag on the left closes an open element on the right, unless a barrier lies between.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
    "main": {"nav", "header"}, "article": {"nav", "header"},
}
BARRIERS = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"},
    "tfoot": {"table"}, "option": {"select"},
}
NO_ARTICLE = frozenset("head nav aside footer form button select option template noscript svg math canvas object dialog menu".split())
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
# Words of class and id names.
NO_ARTICLE_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager footer foot masthead topbar toolbar sidebar sidebars "
    "aside widget widgets related recommended recommendations promo promos promotion ad ads advert adverts advertisement "
    "advertisements advertising sponsor sponsored sponsors banner banners cookie cookies consent gdpr notice notices alert alerts popup "
    "popups modal overlay newsletter subscribe subscription signup login share sharing social comment comments commentlist reply "
    "replies respond disqus discussion copyright hidden".split()
)
ARTICLE_NAMES = frozenset("article articlebody content entry post story main body text maincontent".split())
NOT_SAID = ("has", "no", "not", "with", "without", "is")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@dataclass
class Node:
    tag: str
    parent: int
    step: str = ""
    path: str = ""
    container: bool = False
    gone: bool = False  # no article by tag, role or attribute
    named_gone: bool = False  # no article by class or id
    header: bool = False
    good: float = 1.0


@dataclass
class Block:
    node: int
    text: str
    linked: int  # characters in links
    links: int


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _names(values: list[str]) -> set[str]:
    """Words of class and id names; a class that says what is not there, or what a page merely has, says nothing."""
    found: set[str] = set()
    for value in values:
        for name in value.split():
            parts = [p.lower() for p in NAME_PART.findall(name)]
            if parts and parts[0] not in NOT_SAID:
                found.update(parts)
    return found


def _node(tag: str, rest: str, parent: int, nodes: list[Node]) -> Node:
    got: dict[str, str] = {}
    if rest and not rest.isspace():
        for name, *values in ATTRIBUTE.findall(rest):
            got.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    node = Node(tag, parent, container=tag in CONTAINERS or "-" in tag)
    classes, above = got.get("class", ""), nodes[parent].path if parent >= 0 else ""
    if tag in BLOCKS and tag not in ("html", "body", "p") or node.container and tag != "body":
        shown = sorted({re.sub(r"\d+", "0", c.lower()) for c in classes.split()})
        node.step = ".".join([tag, *shown])
        node.path = f"{above}/{node.step}" if above else node.step
        if len(node.path) > LONGEST_PATH:
            node.path = "~" + hashlib.blake2b(node.path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
    else:
        node.path = above
    if got:
        role = got.get("role", "").lower()
        hidden = "hidden" in got or got.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", got.get("style", ""), re.I)
        node.gone = tag not in ("html", "body") and (role in NO_ARTICLE_ROLES or bool(hidden))
        names = _names([classes, got.get("id", "")])
        if tag not in ("html", "body"):
            node.named_gone = bool(names & NO_ARTICLE_NAMES)
            node.header = "header" in names and tag not in ("article", "main")
        if role in ("main", "article") or got.get("itemprop", "").lower() == "articlebody":
            node.good = 3.0
        elif names & ARTICLE_NAMES:
            node.good = 1.5
    node.gone = node.gone or tag in NO_ARTICLE
    node.header = node.header or tag == "header"
    if tag in ("article", "main"):
        node.good = 3.0
    elif tag == "body":
        node.good = 0.5
    return node


def read(source: str) -> Page:
    """The elements and text blocks of a page, in page order. Node 0 is the body, whether or not there is such a tag."""
    page = Page([Node("body", -1, container=True, good=0.5)])
    nodes, stack = page.nodes, [0]
    text: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked, links
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                at = next(n for n in reversed(stack) if nodes[n].tag in BLOCKS or nodes[n].container)
                page.blocks.append(Block(at, joined, min(linked, len(joined)), links))
            text.clear()
        linked = links = 0

    def pop_to(place: int) -> None:
        del stack[max(place, 1) :]

    def add(piece: str) -> None:
        nonlocal linked
        # Text lies in the innermost element, but inline elements that are no article have blocks of their own.
        piece = html.unescape(piece)
        text.append(piece)
        if in_link():
            linked += len(" ".join(piece.split()))

    def in_link() -> bool:
        return any(nodes[n].tag == "a" for n in reversed(stack[-8:]))

    at = 0
    for token in TOKEN.finditer(source):
        if token.start() > at:
            add(source[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if not tag:
            continue
        tag = tag.lower()
        block = tag in BLOCKS or "-" in tag
        if token["close"]:
            if block:
                flush()
            if tag in ("html", "body"):
                continue
            for place in range(len(stack) - 1, 0, -1):
                other = nodes[stack[place]].tag
                if other == tag:
                    if nodes[stack[place]].gone or nodes[stack[place]].named_gone:
                        flush()
                    pop_to(place)
                    break
                if (not block or tag in ("p", "li", "dt", "dd") or tag in HEADINGS) and (other in CONTAINERS or other in LISTS):
                    break
            continue
        if tag == "br":
            text.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in ("html", "body"):
            flush()
            if tag == "body":
                pop_to(1)
            continue
        if block:
            flush()
            for place in range(len(stack) - 1, 0, -1):
                other = nodes[stack[place]].tag
                if other == "p" or other in HEADINGS and tag in HEADINGS:
                    pop_to(place)
                    break
                if other in BLOCKS:
                    break
        closes = CLOSED_BY.get(tag)
        if closes:
            lowest, stops = 0, BARRIERS.get(tag, ())
            for place in range(len(stack) - 1, 0, -1):
                other = nodes[stack[place]].tag
                if other in stops:
                    break
                if other in closes:
                    lowest = place
            if lowest:
                flush()
                pop_to(lowest)
        elif tag == "a":
            links += 1
            for place in range(len(stack) - 1, 0, -1):
                other = nodes[stack[place]].tag
                if other == "a":
                    pop_to(place)
                if other == "a" or other in BLOCKS:
                    break
        node = _node(tag, token["rest"], stack[-1], nodes)
        if not block and (node.gone or node.named_gone):
            flush()
            node.container = True
        if not token["rest"].endswith("/") or tag not in ("svg", "math"):
            nodes.append(node)
            stack.append(len(nodes) - 1)
    tail = source[at:]
    cut = re.search(r"<[a-z/!?]", tail, re.I)  # a tag that the page's end cuts off
    add(tail[: cut.start()] if cut else tail)
    flush()
    return page


def _settle(page: Page) -> list[bool]:
    """Which elements hold no article: told by their own marks or by those of elements around them."""
    nodes = page.nodes
    marked = [n.named_gone for n in nodes]
    outside = [False] * len(nodes)  # inside something that is no article, class names included
    for i, n in enumerate(nodes):
        outside[i] = n.gone or n.named_gone or n.parent >= 0 and outside[n.parent]
    mains = [i for i, n in enumerate(nodes) if n.tag in ("article", "main") and not n.named_gone and not n.gone]
    if mains and all(outside[i] for i in mains):
        # A name such as "social" on an element around the only article is about something else.
        for i in mains:
            above = nodes[i].parent
            while above >= 0:
                marked[above] = False
                above = nodes[above].parent
    # A form around most of the page and its paragraphs holds the page, and is no form in the text.
    around: set[int] = set()
    if any(n.tag == "form" for n in nodes):
        chars, parts = [0] * len(nodes), [int(n.tag in ("p", "article", "main")) for n in nodes]
        for b in page.blocks:
            chars[b.node] += len(b.text)
        _sum_up(nodes, chars, parts)
        around = {i for i, n in enumerate(nodes) if n.tag == "form" and parts[i] and 2 * chars[i] > chars[0]}
    gone = [False] * len(nodes)
    for i, n in enumerate(nodes):
        gone[i] = n.gone and i not in around or marked[i] or n.parent >= 0 and gone[n.parent]
    return gone


def _within(nodes: list[Node], i: int, outer: int) -> bool:
    while i > outer:
        i = nodes[i].parent
    return i == outer


def _sum_up(nodes: list[Node], *sums: list) -> None:
    """Add every element's numbers to the elements around it; these come first in the list."""
    for i in range(len(nodes) - 1, 0, -1):
        for numbers in sums:
            numbers[nodes[i].parent] += numbers[i]


def _menus(page: Page) -> list[bool]:
    """Which elements lie in lists that are made of links."""
    nodes = page.nodes
    chars, linked, links = ([0] * len(nodes) for _ in range(3))
    for b in page.blocks:
        chars[b.node] += len(b.text)
        linked[b.node] += b.linked
        links[b.node] += b.links
    _sum_up(nodes, chars, linked, links)
    menu = [False] * len(nodes)
    for i, n in enumerate(nodes):
        menu[i] = n.tag in LISTS and links[i] >= 2 and linked[i] >= 0.8 * chars[i] or n.parent >= 0 and menu[n.parent]
    return menu


def _is_menu(b: Block) -> bool:
    return b.links >= 3 and b.linked >= 0.8 * len(b.text)


@dataclass
class Scored:
    """A page with its containers' scores and the blocks that may be text."""

    page: Page
    kept: list[int]  # blocks
    scores: dict[int, float]  # containers

    def best(self) -> list[int]:
        """Containers with a score above 0, best first."""
        return sorted((i for i, s in self.scores.items() if s > 0), key=lambda i: (-self.scores[i], i))

    def inside(self, containers: set[int]) -> str:
        """The text of containers: their blocks, in page order; of headers only what is in headings."""
        nodes = self.page.nodes
        taken, heading, header = ([False] * len(nodes) for _ in range(3))
        for i, n in enumerate(nodes):
            above = n.parent
            if above >= 0 and taken[above]:
                taken[i] = True
                heading[i] = heading[above] or n.tag in HEADINGS
                header[i] = header[above] or n.header
            else:
                taken[i] = i in containers
        blocks = [self.page.blocks[k] for k in self.kept]
        return "\n".join(b.text for b in blocks if taken[b.node] and (heading[b.node] or not header[b.node]))


def scored(source: str | None) -> Scored:
    page = read(source or "")
    nodes = page.nodes
    gone, menus = _settle(page), _menus(page)
    if not any(n.tag in ("article", "main") for n in nodes) and all(gone[b.node] for b in page.blocks):
        # Names alone would leave nothing of a page that marks no article.
        for n in nodes:
            n.named_gone = False
        gone = _settle(page)
    kept = [k for k, b in enumerate(page.blocks) if not gone[b.node] and not menus[b.node] and not _is_menu(b)]
    direct = [0.0] * len(nodes)
    for k in kept:
        b = page.blocks[k]
        direct[b.node] += len(b.text) - 1.5 * b.linked
    scores: dict[int, float] = {}
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        if n.container and not gone[i]:
            # A page's article counts even when it is short.
            semantic = 1.0 if n.tag in ("article", "main") else 0.0
            scores[i] = (direct[i] + semantic) * n.good
        if n.parent >= 0:
            direct[n.parent] += direct[i] * (DISCOUNT if n.container else 1.0)
    return Scored(page, kept, scores)


def votes(source: str | None) -> Counter:
    """Shares of the page's vote by path."""
    page = scored(source)
    best: dict[str, float] = {}
    for i in page.best():
        path = page.page.nodes[i].path
        if path not in best and len(best) == CANDIDATES:
            break
        best.setdefault(path, page.scores[i])
    whole = sum(best.values())
    return Counter({path: int(VOTES * score / whole) for path, score in best.items()})


def main_text(source: str | None, winners: list[str]) -> tuple[str, str | None]:
    """The text of a page and the path it was taken from (null: none)."""
    page = scored(source)
    nodes, best = page.page.nodes, page.best()
    by_path: dict[str, set[int]] = {}
    for i in sorted(page.scores):
        by_path.setdefault(nodes[i].path, set()).add(i)
    own = nodes[best[0]].path if best else None
    path = next((p for p in winners if p in by_path), own)
    if path is None:
        return "", None
    if own in winners and own != path and all(any(_within(nodes, i, j) for j in by_path[path]) for i in by_path[own]):
        path = own
    text = page.inside(by_path[path])
    return text, path if text else None


def _host(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?`` or ``#``, in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[^/?#]*://([^/?#]*)", 1), F.lit("")))


def consensus(pages: DataFrame) -> DataFrame:
    """``host`` and ``winners``, its winning paths, most votes first."""

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast_votes: Counter = Counter()
            for host, source in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
                for path, share in votes(source).items():
                    cast_votes[host, path] += share
            keys = list(cast_votes)
            yield pa.RecordBatch.from_pydict(
                {"host": [h for h, _ in keys], "path": [p for _, p in keys], "votes": [cast_votes[k] for k in keys]},
                schema=pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.int64())]),
            )

    common.small_batches(pages.sparkSession)
    asked = pages.select(_host(F.col("url")).alias("host"), "html").mapInArrow(cast, "host string, path string, votes long")
    by_path = common.stored(asked.groupBy("host", "path").agg(F.sum("votes").alias("votes")), "votes")
    of_host = by_path.groupBy("host").agg(F.sum("votes").alias("total"))
    winning = by_path.join(of_host, "host").where((F.col("votes") > 0) & (F.col("votes") >= LEAST_SHARE * F.col("total")))
    # At most 1 / LEAST_SHARE paths of a host are collected.
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("less"), "path")))
    return common.stored(winning.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("winners")), "winners")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points), ``host`` and ``path`` (where the text was; null: nowhere)."""
    pages = pages.select("page_id", "url", "html")
    asked = pages.withColumn("host", _host(F.col("url"))).join(consensus(pages), "host", "left")
    kept = ("page_id", "url")
    schema = T.StructType([asked.schema[name] for name in kept])
    schema = schema.add("text", "string").add("n_chars", "long").add("host", "string").add("path", "string")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(source, winners or []) for source, winners in zip(batch["html"].to_pylist(), batch["winners"].to_pylist())]
            texts = [text for text, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[name] for name in kept),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                    batch["host"],
                    pa.array([path for _, path in found], pa.string()),
                ],
                names=schema.names,
            )

    return asked.mapInArrow(take, schema)
