"""Main text of web pages by consensus paths.

First pass: every page is read into blocks of text, each under a container, and every container is
scored by the running text in it. Containers are named by generalised paths: tags with their
classes, digits replaced, the last eight steps. Spark sums the pages' votes per host and path.
Second pass: pages are read again and the blocks under the host's winning path are kept, extended
to the article or main around it; a page without that path falls back on its own best container.
A page's only h1 that stands outside of them is its headline and is kept, also in a page header, unless
over half of a host's pages (of three at least) have the same one: then it is the site's name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .base import fresh
from .url_filter import url_host

STEPS = 8
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile(r"\d+")
_NAME_PARTS = re.compile(r"[^a-z]+")
# HTML elements by their role.
_RAW = {"script", "style", "title", "noscript", "template", "textarea", "iframe", "svg", "select", "annotation", "annotation-xml"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CONTAINERS = {"body", "main", "article", "section", "div", "td", "blockquote", "center", "aside", "nav", "header", "footer", "form"}
_BLOCKS = _CONTAINERS | {"html", "head", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "tr", "th", "tbody", "thead",
                         "tfoot", "pre", "figure", "figcaption", "fieldset", "address", "details", "summary", "hr", "dialog", "caption", "menu"}
_ENDS_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
_WRAPPERS = {"div", "section", "center", "td"}
_ASIDE_TAGS = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head"}
_ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"}
_ASIDE_NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs "
                   "footer comment comments disqus replies cookie cookies consent notice notices alert popup modal newsletter subscribe signup login share sharing "
                   "social related recommended widget pagination pager masthead skip toolbar".split())


@dataclass
class Node:
    parent: int
    path: str
    aside: bool
    score: float = 0.0
    tag: str = ""


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=lambda: [Node(-1, "", False)])
    blocks: list[tuple[int, bool, str]] = field(default_factory=list)  # container, aside, text
    headline: str | None = None  # text of the only h1, if it may be the article's
    head_blocks: set[int] = field(default_factory=set)  # numbers of the blocks in a h1


@dataclass
class Mark:
    """An element that isn't the article. ``weak``: a wrapper that is marked by a part of a class or id only."""

    parent: int
    weak: bool = False
    heads: bool = False  # holds a h1, article or main
    header: bool = False  # a page header that nothing else marks
    text: float = 0.0


def _attributes(raw: str) -> tuple[str, bool, bool]:
    """Generalised classes, whether a name or role marks what isn't the article, and whether only a
    part of a longer name does."""
    classes, aside, weak = "", False, True
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        value = unescape(a or b or c).lower()
        name = name.lower()
        if name == "class":
            classes = "".join("." + _DIGITS.sub("#", x) for x in sorted(set(value.split())))
        if name == "role":
            aside |= value.strip() in _ASIDE_ROLES
            weak &= value.strip() not in _ASIDE_ROLES
        elif not _ASIDE_NAMES.isdisjoint(_NAME_PARTS.split(value)):
            aside = True
            weak &= all(_NAME_PARTS.sub("", x) not in _ASIDE_NAMES for x in value.split())
    return classes, aside, weak


def read_page(html: str) -> Page:
    """Blocks in page order. Tags may be left open, closed twice or cut off at the end."""
    page = Page()
    stack: list[tuple[str, int, int, str, int]] = []  # tag, container, mark (0 for none), step of the path, number of the h1 (0 for none)
    marks = [Mark(0)]
    marked_nodes = [0]
    found_blocks: list[tuple[int, int, str, float, int]] = []  # container, mark, text, weight, h1
    texts: list[str] = []
    linked = 0
    links = 0
    heads = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(texts)).split())
        texts.clear()
        if text:
            node, mark, head = (stack[-1][1], stack[-1][2], stack[-1][4]) if stack else (0, 0, 0)
            found_blocks.append((node, mark, text, float(max(0, len(text) - 2 * linked)), head))
        linked = 0

    at, n = 0, len(html)
    while at < n:
        found = _TAG.search(html, at)
        end = found.start() if found else n
        if end > at:
            texts.append(html[at:end])
            if links:
                linked += end - at
        if not found:
            break
        at = found.end()
        close, name, raw, finish = found.group(1, 2, 3, 4) if found.group(2) else found.group(5, 6, 7, 8)
        if not name or not finish:
            continue
        name = name.lower()
        if name in _BLOCKS:
            flush()
        elif name == "br":
            texts.append(" ")
        if close:
            if name == "a":
                links = max(0, links - 1)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if stack[i][0] in ("td", "th", "table") and name not in ("table", "tr", "tbody", "html", "body"):
                    break
            continue
        if name in _RAW:
            if not raw.rstrip().endswith("/"):
                ending = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = ending.end() if ending else n
            continue
        if name in _VOID:
            continue
        if name == "a":
            links += 1
        if name in _BLOCKS and name not in ("html", "body", "head"):
            links = 0
            for i in range(len(stack) - 1, -1, -1):
                tag = stack[i][0]
                if tag == "p" or tag in _ENDS_ITSELF.get(name, ()):
                    del stack[i:]
                    if tag == "p" and name in _ENDS_ITSELF and name != "p":
                        continue
                    break
                if tag in _STOPS.get(name, ()) or tag in _CONTAINERS and name not in ("tr",):
                    break
        elif name == "body":
            stack = [s for s in stack if s[0] == "html"]
        node, mark, head = (stack[-1][1], stack[-1][2], stack[-1][4]) if stack else (0, 0, 0)
        if name == "h1":
            heads += 1
            head = heads
        classes, named, weak = _attributes(raw) if raw else ("", False, True)
        step = name + classes
        if name not in ("html", "body", "article", "main"):
            role = name in _ASIDE_TAGS or name == "header" and not any(s[0] in ("article", "main") for s in stack)
            if named or role:
                marks.append(Mark(mark, weak and not role and name in _WRAPPERS, header=name == "header" and not named))
                mark = len(marks) - 1
        if name in ("h1", "article", "main"):
            up = mark
            while up and not marks[up].heads:
                marks[up].heads = True
                up = marks[up].parent
        if name in _CONTAINERS:
            steps = [s[3] for s in stack[-(STEPS - 1) :] if s[0] in _BLOCKS]
            page.nodes.append(Node(node, "/".join([*steps, step]), False, tag=name))
            marked_nodes.append(mark)
            node = len(page.nodes) - 1
        stack.append((name, node, mark, step, head))
    flush()
    _settle(page, marks, marked_nodes, found_blocks)
    return page


def _settle(page: Page, marks: list[Mark], marked_nodes: list[int], blocks: list[tuple[int, int, str, float, int]]) -> None:
    """Decides which marks hold and scores the containers. A weak mark is lifted if its wrapper holds
    most of the running text that isn't surely aside: over half with a heading in it, else nine tenths."""
    sure = [False] * len(marks)
    for i, m in enumerate(marks[1:], 1):
        sure[i] = sure[m.parent] or not m.weak
    for _, mark, _, weight, _ in blocks:
        if not sure[mark]:
            marks[mark].text += weight
    for m in reversed(marks[1:]):
        marks[m.parent].text += m.text
    total = marks[0].text
    aside = [False] * len(marks)
    beyond = [False] * len(marks)  # aside by more than a page header
    for i, m in enumerate(marks[1:], 1):
        lifted = m.weak and m.text > total * (0.5 if m.heads else 0.9)
        aside[i] = aside[m.parent] or not lifted
        beyond[i] = beyond[m.parent] or not (lifted or m.header)
    for node, mark in zip(page.nodes, marked_nodes, strict=True):
        node.aside = aside[mark]
    whole = [0.0] * len(page.nodes)
    titles: dict[int, list[str]] = {}
    for node, mark, text, weight, head in blocks:
        if head and not beyond[mark]:
            page.head_blocks.add(len(page.blocks))
            titles.setdefault(head, []).append(text)
        page.blocks.append((node, aside[mark], text))
        if not aside[mark]:
            whole[node] += weight
            while node >= 0 and weight >= 1:
                page.nodes[node].score += weight
                node, weight = page.nodes[node].parent, weight / 2
    if len(titles) == 1:
        page.headline = "\n".join(*titles.values())
    # A container whose text is dealt over parts of different paths stands for all of it.
    largest: dict[int, dict[str, float]] = {}
    for i in range(len(page.nodes) - 1, 0, -1):
        node = page.nodes[i]
        whole[node.parent] += whole[i]
        if whole[i]:
            parts = largest.setdefault(node.parent, {})
            parts[node.path] = parts.get(node.path, 0.0) + whole[i]
        if node.tag != "body" and i in largest and max(largest[i].values()) * 3 <= whole[i] * 2:
            node.score = max(node.score, whole[i])


def votes(page: Page) -> list[tuple[str, float]]:
    """Share of the page's running text per path; halves of it go to the parents."""
    total = sum(len(text) for _, aside, text in page.blocks if not aside)
    by_path: dict[str, float] = {}
    for node in page.nodes[1:]:
        if not node.aside and node.score > 0:
            by_path[node.path] = by_path.get(node.path, 0.0) + node.score / total
    return list(by_path.items())


def extract(page: Page, winner: str | None, site: str | None = None) -> str:
    """Blocks under the winning path, else under the page's best container, else all that isn't aside.

    The page's headline leads them where they hold no h1, unless it is ``site``, the site's name.
    """
    top = [i for i, node in enumerate(page.nodes) if i and not node.aside and node.path == winner]
    if not top:
        top = [max(range(len(page.nodes)), key=lambda i: (page.nodes[i].score, i))]
    inside = [False] * len(page.nodes)
    for i in _extended(page, top):
        inside[i] = True
    for i, node in enumerate(page.nodes[1:], 1):
        inside[i] = inside[i] or inside[node.parent]
    kept = {i for i, (node, aside, _) in enumerate(page.blocks) if inside[node] and not aside}
    if kept and page.headline not in (None, site) and kept.isdisjoint(page.head_blocks):
        kept |= page.head_blocks
    return "\n".join(page.blocks[i][2] for i in sorted(kept))


def _extended(page: Page, top: list[int]) -> set[int]:
    """The nearest article or main of each container; the common ancestor of several that stand in none."""
    out, bare = set(), []
    for i in top:
        at = i
        while at > 0 and page.nodes[at].tag not in ("article", "main"):
            at = page.nodes[at].parent
        if at > 0:
            out.add(at)
        else:
            bare.append(i)
    if bare:
        common = bare[0]
        for i in bare[1:]:
            while i != common:  # parents have smaller numbers
                if i > common:
                    i = page.nodes[i].parent
                else:
                    common = page.nodes[common].parent
        out.add(common)
    return out


def host_votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, path, headline, votes, pages: the votes of all pages, summed per host and path; and, without
    a path, the number of the host's pages with each headline (null for none)."""

    @F.pandas_udf("array<struct<path:string,headline:string,share:double>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for h in batch:
                page = read_page(h or "")
                own = [{"path": p, "headline": None, "share": s} for p, s in votes(page)]
                out.append([*own, {"path": None, "headline": page.headline, "share": 0.0}])
            yield pd.Series(out)

    cast = pages.select(url_host(F.col(url)).alias("host"), F.explode(scored(F.col(html))).alias("v"))
    return cast.groupBy("host", "v.path", "v.headline").agg(F.round(F.sum("v.share"), 6).alias("votes"), F.count("*").alias("pages"))


def winning_paths(cast: DataFrame) -> DataFrame:
    """host, winner (path of most votes, ties to the longer and then the later one; null if none has any)
    and site (the headline of over half of the host's pages, if it has three or more)."""
    best = F.max(F.when(F.col("path").isNotNull(), F.struct("votes", F.length("path").alias("n"), "path"))).alias("best")
    titles = F.when(F.col("path").isNull(), F.col("pages"))
    usual = F.max(F.when(F.col("path").isNull() & F.col("headline").isNotNull(), F.struct("pages", "headline"))).alias("usual")
    hosts = cast.groupBy("host").agg(best, usual, F.sum(titles).alias("n"))
    site = F.when((F.col("n") > 2) & (F.col("usual.pages") * 2 > F.col("n")), F.col("usual.headline"))
    return hosts.select("host", F.col("best.path").alias("winner"), site.alias("site"))


def main_text(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """Adds the main text to every row; other columns and repeated rows stay, a column ``out`` is replaced.

    A null or empty page has an empty text. Pages without a host share the empty host.
    """
    own, host, winner, site = (fresh(pages, n) for n in ("own_host", "host", "winner", "site"))
    winners = stage(winning_paths(host_votes(pages, url, html)), "host-paths").toDF(host, winner, site)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series([extract(read_page(h), p, t) if h else "" for h, p, t in zip(*columns, strict=True)], dtype=object)

    joined = pages.withColumn(own, url_host(F.col(url))).join(winners, F.col(own) == F.col(host), "left")
    return joined.withColumn(out, text_of(F.col(html), F.col(winner), F.col(site))).drop(own, host, winner, site)
