"""Main text of pages whose templates have no telling tags or classes, against a brute-force version."""

from __future__ import annotations

import random
from collections import defaultdict
from html.parser import HTMLParser

import pytest

from stratalake.llm import html_main


class Tree(HTMLParser):
    """Elements of well-formed pages as [name, children]; text as strings."""

    def __init__(self, page):
        super().__init__()
        self.root = ["", []]
        self.stack = [self.root]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        self.stack[-1][1].append([tag, []])
        self.stack.append(self.stack[-1][1][-1])

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        self.stack[-1][1].append(data)


def length(node):
    return sum(len(c.strip()) if isinstance(c, str) else length(c) for c in node[1])


def brute(pages):
    """Texts of pages made of div, p and body: divs that stand beside 5 different articles of a host go."""
    trees = {k: Tree(page).root for k, (_, page) in pages.items()}

    def holders(tree):
        """The elements around what holds most of the text."""
        path, node = [tree], tree
        while (best := next((c for c in node[1] if not isinstance(c, str) and 2 * length(c) > length(tree)), None)) is not None:
            path.append(best)
            node = best
        return path

    def divs(node):
        for c in node[1]:
            if not isinstance(c, str):
                if c[0] == "div":
                    yield c
                yield from divs(c)

    beside = defaultdict(set)
    for k, (host, _) in pages.items():
        path = holders(trees[k])
        for d in divs(trees[k]):
            if not any(d is p for p in path):
                beside[host, repr(d)].add(repr(trees[k]))
    texts = {}
    for k, (host, _) in pages.items():
        path, blocks = holders(trees[k]), []

        def walk(node, host=host, path=path, blocks=blocks):
            for c in node[1]:
                if isinstance(c, str):
                    blocks.append(" ".join(c.split()))
                elif c[0] != "div" or any(c is p for p in path) or len(beside[host, repr(c)]) < 5:
                    walk(c)

        walk(trees[k])
        texts[k] = "\n".join(b for b in blocks if b)
    return texts


def words(rng, n):
    return " ".join(f"w{rng.randrange(500)}" for _ in range(n))


def generated(seed, hosts=6, pages=240):
    rng = random.Random(seed)
    parts = {h: [f"<div><div>{words(rng, 4)}</div><p>{words(rng, 6)}</p></div>" for _ in range(8)] for h in range(hosts)}
    out = {}
    for k in range(pages):
        h = min(rng.randrange(hosts), rng.randrange(hosts))
        before, after = ("".join(rng.sample(parts[h], rng.randrange(4))) for _ in range(2))
        inside = rng.choice(parts[h]) if rng.random() < 0.3 else f"<div>{words(rng, 8)}</div>"
        own = "".join(f"<p>{words(rng, 30)}</p>" for _ in range(3))
        out[k] = f"h{h}.example", f"<body><div>{before}<div><p>{words(rng, 40)}</p>{inside}{own}</div>{after}</div></body>"
    return out


def extracted(spark, pages):
    rows = [(k, f"https://{host}/{k}", page, "x") for k, (host, page) in pages.items()]
    return {r.page_id: r for r in html_main.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string, template string")).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_without_telling_tags(spark, seed):
    pages = generated(seed)
    got, want = extracted(spark, pages), brute(pages)
    assert {k: r.text for k, r in got.items()} == want
    assert sum(r.template_subtrees for r in got.values()) > 300 and all(r.n_chars == len(r.text) for r in got.values())


def test_a_blocks_fate_does_not_depend_on_the_size_of_its_host(spark):
    rng = random.Random(5)
    block = "<div>a block of the site</div>"

    def page(with_block):
        return f"<body><article><p>{words(rng, 30)}</p>{block if with_block else ''}</article></body>"

    pages = {k: ("small", page(k < 6)) for k in range(6)} | {100 + k: ("large", page(k < 6)) for k in range(400)}
    pages |= {600 + k: ("few", page(k < 4)) for k in range(4)}
    got = extracted(spark, pages)
    assert all("a block" not in r.text for k, r in got.items() if k < 600)
    assert all("a block" in r.text for k, r in got.items() if k >= 600)


def test_menus_and_footers_count_as_templates(spark):
    rng = random.Random(6)
    pages = {k: ("h", f"<nav><div>Home</div></nav><article><p>{words(rng, 20)}</p></article><footer>f</footer>") for k in range(7)}
    assert {r.template_subtrees for r in extracted(spark, pages).values()} == {2}


ARTICLE = "<article><h1>Title</h1><p>One two three.</p></article>"


@pytest.mark.parametrize(("page", "text"), [
    *[(f"<nav>menu</nav><div class='{c}'>{ARTICLE}</div><footer>f</footer>", "Title\nOne two three.") for c in (
        "layout has-sidebar", "no-sidebar", "search-results", "share-enabled", "main-nav-open", "with-comments")],
    ("<form id=f>" + ARTICLE + "</form>", "Title\nOne two three."),
    ("<article><p class='social'>a</p><p>x <span class='notice'>b</span> y</p><section id='search'><p>c</p></section>"
     "<p>d <math><mi>e</mi></math></p><p>f <label>g</label> h <span class=ad>BUY <b>now</b></span>i</p></article>", "a\nx b y\nc\nd\ne\nf g h i"),
    ("<main><h1>T</h1><article><p>long long long</p><article><p>reply</p></article></article>"
     "<div id='c'><article><p>nice</p></article></div><p>tail</p><div>box</div></main>", "T\nlong long long\ntail"),
    ("<article><p>a <span hidden>b<p>c</article>", "a\nc"),
])
def test_names_do_not_empty_articles(page, text):
    assert html_main.main_text(page, set()) == (text, 0)
