"""Main text of web pages: site templates are found by counting element subtrees per host, and removed.

Every subtree of a page that does not hold its article, menus and footers included, is
hashed; Spark counts for each host beside how many different articles it stands. Those that
recur go wherever they stand. Rules by tag and by class are applied to what is left: menus,
forms, scripts and the like go unless they hold the article, and so do elements whose class, id or
role says that they are no part of it.

A page's article is the longest of its ``article`` elements with what stands directly
beside it in ``main``; other ``article`` elements are comments or teasers. Without any it is the longest
``main``, or the body. Paragraphs, headings and list items do not go for recurring, as
articles may share them; what holds the article does not either.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.tables import removed, written
from stratalake.llm.words import rows_of

#: A subtree belongs to a host's template if it is beside so many different articles, however large the host.
LEAST_PAGES = 5

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[/a-zA-Z][^>]*(?:>|\Z)",
    re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "math", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "wbr",
}
#: Elements that hold an article's own text.
_TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "blockquote", "pre", "figcaption", "caption"}
_NEVER = _RAW | {
    "head", "nav", "footer", "aside", "form", "svg", "canvas", "button", "select", "option", "object", "dialog", "menu", "audio",
    "video", "fieldset", "applet",
}
_WHOLE = {"html", "body", "article", "main"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
_ADVERTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion"}
_HINTS = _ADVERTS | {
    "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "login", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
    "masthead", "footer", "comment", "comments", "disqus", "reply", "replies", "related", "recommended", "recommendations",
    "share", "sharing", "social", "widget", "widgets", "toolbar", "pagination", "pager", "search", "skip", "hidden",
}
#: Of an id inside an article, only these; a section of the article may well be named after the others.
_IDS = _ADVERTS | {"comment", "comments", "disqus", "reply", "replies", "sidebar", "newsletter", "related"}
_OTHER_ARTICLES = {"comment", "comments", "reply", "related", "ad", "sponsored", "promo", "teaser"}

#: Why an element may go: its class, id or role; its tag; its tag, whatever it holds.
HINT, TAG, RAW = 1, 2, 3


@dataclass
class Node:
    name: str
    parent: int
    reason: int
    start: int
    end: int = 0
    size: int = 0


def _attributes(source: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(source)}


def _hinted(name: str, source: str, inside: bool) -> bool:
    """Whether an element's attributes tell that it is no part of an article."""
    if not source or source.isspace():
        return name == "header" and not inside
    a = _attributes(source)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    words, ids = (set(re.split(r"[^a-z]+", a.get(k, "").lower())) for k in ("class", "id"))
    if name in _WHOLE:
        return name == "article" and bool((words | ids) & _OTHER_ARTICLES)
    if name in _INLINE or inside and name in _TEXT:
        return bool((words | ids) & _ADVERTS)
    if a.get("role", "").lower() in _ROLES:
        return True
    return bool(words & _HINTS or ids & (_IDS if inside else _HINTS)) or not inside and (name == "header" or "header" in words | ids)


def parse(page: str) -> tuple[list[Node], list[tuple[str, int]]]:
    """Elements that are not inline, in page order, and the blocks of text with their element."""
    nodes, blocks = [Node("", -1, 0, 0)], []
    stack, text, at, raw = [0], [], 0, ""
    inside = 0  # open article and main elements
    skipped, depth = "", 0  # an inline element whose text goes, and how many of its name are open

    def flush() -> None:
        nonlocal skipped
        skipped = ""
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            if block:
                blocks.append((block, stack[-1]))
                nodes[stack[-1]].size += len(block)
            text.clear()

    def close(k: int, end: int) -> None:
        nonlocal inside
        for n in stack[k:]:
            nodes[n].end = end
            inside -= nodes[n].name in ("article", "main")
        del stack[k:]

    for m in _MARKUP.finditer(page):
        closing, name, source = m.group(1), (m.group(2) or "").lower(), m.group(3) or ""
        if raw:
            if not (closing and name == raw):
                continue
            at = m.start()
        if m.start() > at and not skipped:
            text.append(page[at:m.start()])
        at = m.end()
        if not name:
            continue
        if skipped and name == skipped:
            depth += -1 if closing else 1
            if not depth:
                skipped = ""
            continue
        if closing:
            raw = ""
            k = next((k for k in range(len(stack) - 1, 0, -1) if nodes[stack[k]].name == name), 0)
            if name not in _INLINE:
                flush()
            if k:
                close(k, m.end())
            continue
        if name in _INLINE:
            if name == "br":
                text.append(" ")
            elif not skipped and name not in _VOID and _hinted(name, source, bool(inside)):
                skipped, depth = name, 1
            continue
        flush()
        if name in _VOID or source.endswith("/") and name not in _RAW:
            continue
        if nodes[stack[-1]].name in ("p", name) and name in (_TEXT - {"blockquote"}) | {"div", "ul", "ol", "table", "section", "article"} \
                and (nodes[stack[-1]].name == "p" or name in _TEXT):
            close(len(stack) - 1, m.start())
        reason = RAW if name in _RAW or name == "head" else TAG if name in _NEVER else HINT if _hinted(name, source, bool(inside)) else 0
        if name in _RAW:
            raw = name
        if name not in _TEXT or reason:
            inside += name in ("article", "main")
            nodes.append(Node(name, stack[-1], reason, m.start()))
            stack.append(len(nodes) - 1)
    if not raw and not skipped and at < len(page):
        text.append(page[at:])
    flush()
    close(0, len(page))
    return nodes, blocks


@dataclass
class Layout:
    """A page's elements and blocks, which elements hold the article, which are it, and which beside it count by their own text."""

    nodes: list[Node]
    blocks: list[tuple[str, int]]
    holds: set[int]
    root: int
    beside: set[int]
    others: set[int]


def layout(page: str) -> Layout:
    nodes, blocks = parse(page)
    raw, outside = [n.reason == RAW for n in nodes], [n.reason == RAW for n in nodes]
    total = [0] * len(nodes)
    for k, n in enumerate(nodes):
        if n.parent >= 0:
            raw[k] = raw[k] or raw[n.parent]
            outside[k] = outside[k] or outside[n.parent] or n.reason == TAG and n.name not in ("form", "fieldset")
        total[k] = 0 if raw[k] else n.size
    own = list(total)  # of an article without the articles in it
    for k in range(len(nodes) - 1, 0, -1):
        total[nodes[k].parent] += total[k]
        if nodes[k].name != "article":
            own[nodes[k].parent] += own[k]

    def longest(name: str) -> int:
        found = [k for k, n in enumerate(nodes) if n.name == name and not raw[k]]
        best = [k for k in found if not outside[k] and not nodes[k].reason] or [k for k in found if not outside[k]] or found
        return max(best, key=lambda k: (own[k], -k), default=0)

    root = longest("article") or longest("main")
    up, holds = root, set()
    if not root:  # what most of the text stands in
        soft = [0 if outside[k] else t for k, t in enumerate(total)]
        up = max((k for k, n in enumerate(nodes) if 2 * soft[k] > total[0]), default=0)
    while up >= 0:
        holds.add(up)
        up = nodes[up].parent
    articles = {k for k, n in enumerate(nodes) if n.name == "article" and k not in holds}
    mains = [k for k in holds if nodes[k].name == "main"]
    beside = {k for k in holds if mains and k >= min(mains)} - {root} if root and nodes[root].name == "article" else set()
    return Layout(nodes, blocks, holds, root, beside, articles if root else set())


def subtree_hash(page: str, node: Node) -> int:
    value = xxhash.xxh64_intdigest(" ".join(page[node.start:node.end].split()).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >= 1 << 63 else value


def _could_go(k: int, node: Node, at: Layout) -> bool:
    return k not in at.holds and node.name not in _WHOLE and node.name not in _TEXT and node.reason != RAW


def subtrees(page: str) -> tuple[set[int], int]:
    """Hashes of all subtrees that do not hold the article, and a hash of the page's own article."""
    at = layout(page)
    within = [k == at.root for k in range(len(at.nodes))]
    for k, n in enumerate(at.nodes):
        within[k] = within[k] or n.parent >= 0 and within[n.parent]
    article = "\n".join(text for text, k in at.blocks if within[k] and not at.nodes[k].reason)
    found = {subtree_hash(page, n) for k, n in enumerate(at.nodes) if k and _could_go(k, n, at)}
    return found, xxhash.xxh64_intdigest(article.encode("utf-8", "surrogatepass")) >> 1


def main_text(page: str, template: set[int]) -> tuple[str, int]:
    """Blocks of the article in page order, one line each, and how many subtrees went as parts of the template."""
    at = layout(page)
    nodes = at.nodes
    within, gone, removed = [k == at.root for k in range(len(nodes))], [False] * len(nodes), 0
    for k, n in enumerate(nodes):
        up = n.parent
        within[k] = within[k] or up >= 0 and within[up]
        if up >= 0 and gone[up]:
            gone[k] = True
        elif template and k and _could_go(k, n, at) and subtree_hash(page, n) in template:
            gone[k], removed = True, removed + 1
        else:
            gone[k] = n.reason == RAW or k in at.others or bool(n.reason) and k not in at.holds
    return "\n".join(text for text, k in at.blocks if (within[k] or k in at.beside) and not gone[k]), removed


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page its subtrees' hashes, each with the article's hash."""
    def batch() -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip((hosts, keys, hashes, articles), kinds, strict=True)], names=["host", "page", "hash", "article"])

    hosts, keys, hashes, articles = [], [], [], []
    for host, key, page in rows_of(batches, "host", "page", "html"):
        if page:
            found, article = subtrees(page)
            hosts += [host] * len(found)
            keys += [key] * len(found)
            hashes += found
            articles += [article] * len(found)
        if len(hosts) > 20_000:
            yield batch()
            hosts, keys, hashes, articles = [], [], [], []
    if hosts:
        yield batch()


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            found = [main_text(page, set(template or ())) if page else ("", 0) for page, template in rows_of([part], "html", "template")]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array([t for t, _ in found], pa.string()),
                 pa.array([len(t) for t, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars", "template_subtrees"])


def _pages(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"),
        F.when(host != "", host).alias("host"), F.md5("html").alias("page"))


def templates(pages: DataFrame) -> DataFrame:
    """``host, page, template``: for each page, by a digest of its html, the hashes of its subtrees that recur on its host.

    Pages count by their articles: copies of one article are one page, as all that is in them
    recurs. Hashes are joined back to the pages that have them, so a list is never longer than a
    page has elements; no step is by host alone.
    """
    known = _pages(pages).where("host is not null").select("host", "page", "html")
    found = written(known.mapInArrow(_counted, "host string, page string, hash long, article long"), "subtrees")
    counts = found.select("host", "hash", "article").distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    recurring = written(counts.where(F.col("n") >= LEAST_PAGES).select("host", "hash"), "recurring")
    lists = written(found.join(recurring, ["host", "hash"], "left_semi").groupBy("host", "page").agg(
        F.collect_set("hash").alias("template")), "templates")
    removed(found, recurring)
    return lists


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, template_subtrees`` per row of ``pages (page_id, url, html)``.

    The last column counts the subtrees that went as parts of the site's template. NULL and empty pages, and pages without any
    text of an article, have an empty text. Pages whose url has no host are treated without a
    template. Repeated rows and NULL ids give a row each; no rows give none; other columns are not looked at. A page that breaks off
    is taken as far as it goes; a tag that is cut off is no text. A very long page is parsed whole by the task that reads it.
    """
    return _pages(pages).join(templates(pages), ["host", "page"], "left").select("page_id", "url", "html", "template").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long, template_subtrees long")
