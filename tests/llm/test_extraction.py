from __future__ import annotations

import html
import itertools
import math
import random
import re
from collections import Counter

import oracle
import pytest

from crestline.llm import dom, extraction
from crestline.llm.common import read_table

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, text string, n_chars string, seed string"


@pytest.fixture(scope="module")
def model(spark):
    return extraction.fit_unlabelled(read_table(spark, SF_DIR, "pages"))


def blocks(source):
    """Blocks of a page whose article has headings and paragraphs only."""
    body = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    parts = re.split(r"</?(?:p|h1)>", body)
    return [t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in parts) if t]


def test_query_returns_the_articles(spark):
    got = {r.page_id: r for r in extraction.op11_html_extraction(spark, SF_DIR).collect()}
    pages = read_table(spark, SF_DIR, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        want = "\n\n".join(blocks(p.html))
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, want, len(want))


def test_query_equals_sql(spark):
    got = oracle.spark_result(extraction.op11_html_extraction(spark, SF_DIR))
    assert got == oracle.duckdb_result(oracle.connect(SF_DIR), extraction.ARTICLES_SQL)


def exact(page, model):
    """Marginals by adding up all labellings."""
    seen, chars, sizes = extraction.observations(page)
    leaf = min(extraction.WEIGHT, extraction.EVIDENCE / max(sizes[0], 1))
    kinds = extraction.edge_kinds(page)
    live = [i for i in range(len(page.parent)) if chars[i]]
    total, own = 0.0, [0.0] * len(page.parent)
    for ys in itertools.product((0, 1), repeat=len(live)):
        y = dict(zip(live, ys))
        p = 1.0
        for i in live:
            e = (model.edges.get(kinds[i]) or model.edges.get(kinds[i].split()[0], model.other))[y[page.parent[i]] if page.parent[i] >= 0 else 1]
            p *= e if y[i] else 1 - e
            if y[i]:
                p *= math.exp((extraction.WEIGHT if page.text[i] is None else leaf) * sum(model.nodes.get(x, 0.0) for x in seen[i]))
        total += p
        for i in live:
            own[i] += p * y[i]
    return [x / total for x in own]


def test_messages_give_the_marginals_of_all_labellings(model):
    sources = [
        "<body><nav><a>x y</a></nav><div><p>One two. <p>Three <a>four</a> five.</div><footer>z</footer>",
        "<div class=x1><h1>Head</h1><p>Some words here.</p></div><div class=x2><a>l</a><a>m</a><p>no</p></div>",
        "<main><article><p>a b c.</p><div class=comments><p>Long comment of some words.</p></div></article></main>",
        "word", "<div><div><div><div>deep words.</div></div></div></div>",
    ]
    for s in sources:
        page = dom.parse(s)
        assert extraction.marginals(page, model) == pytest.approx(exact(page, model), abs=1e-9)


def test_a_page_without_an_article_element(model):
    text = [" ".join(random.Random(i).choices("some words make a plain sentence of prose".split(), k=25)) + "." for i in range(6)]
    source = (
        "<html><head><title>T</title><script>if (a < b) document.write('<p>no</p>')</script></head><body>"
        "<header><a href=/>Site</a></header><div class='nav-menu'><ul><li><a href=/1>Home</a><li><a href=/2>News</a></ul></div>"
        "<div class='cookie-consent'><p>We use cookies on this site.</p><button>Accept all</button></div>"
        "<div id='content'><h1>Title &amp; more</h1>" + "".join(f"<p>{t}" for t in text) +
        "<div class='advert'>Buy it now.</div><ul><li>first point</li><li>second point</li></ul></div>"
        "<aside><h3>Popular</h3><ul><li><a href=/3>Other story</a></li></ul></aside>"
        "<section class='comments'><h3>Comments</h3><div class=comment><p>" + text[0] + "</p></div></section>"
        "<form><label>Mail</label><input><button>Send</button></form><footer>&copy; 2020 Site</footer>"
    )
    assert extraction.extract(source, model) == ["Title & more", *text, "first point", "second point"]


def test_layouts_held_out(model):
    words = [f"w{i}" + "x" * (i % 9) for i in range(500)]
    good = found = true = 0
    for seed in range(10**6, 10**6 + 400):
        source = extraction.layout(words, seed)
        page = dom.parse(source, extraction.MARK)
        y, p = extraction.labels(page), extraction.marginals(page, model)
        for i, t in enumerate(page.text):
            if t is not None:
                good += len(t) * (y[i] and p[i] > 0.5)
                found += len(t) * (p[i] > 0.5)
                true += len(t) * y[i]
    assert good / found > 0.96 and good / true > 0.95


def test_training_on_marked_pages(spark):
    """The label decides, not the names: here the menu is the content."""
    rows = [(i, f"<nav {extraction.MARK}=1><a>l{i}</a><a>m</a></nav><article><p>Some prose of {i}.</p></article>") for i in range(30)]
    model = extraction.fit(spark.createDataFrame(rows, "page_id long, html string"))
    assert extraction.extract("<nav><a>x</a> <a>y</a></nav><article><p>Prose here.</p></article>", model) == ["x y"]


def test_edges(spark, model):
    long = "<article>" + "".join(f"<p>Sentence number {i} of a long page.</p>" for i in range(20_000)) + "</article>"
    deep = "<div>" * 5_000 + "<p>deep text.</p>"
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "   "), (4, "u", "<script>var x = '<p>a</p>';</script><style>p{}</style>"),
        (None, "u", "<article><p>Null id &lt;b&gt; &#233;&nbsp;x.</p></article>"), (5, "u", long), (6, "u", deep),
        (7, "u", "<article><p>cut off <b>here <a hre"), (7, "u", "<article><p>cut off <b>here <a hre"),
        (8, "u", "<nav><a>a</a></nav>"), (9, "u", "<!-- <article>no</article> -->"), (10, "u", '<p title="a > b">x</p' * 50),
    ]
    table = spark.createDataFrame([(*r, "t", "n", "s") for r in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in extraction.main_text(table, model).collect()), key=str)
    assert len(got) == len(rows) and all(r[3] == len(r[2]) for r in got)
    by = {r[0]: r[2] for r in got}
    assert by[1] == by[2] == by[3] == by[4] == by[9] == "" and by[8] == ""
    assert by[None] == "Null id <b> é x." and by[7] == "cut off here"
    assert by[5].count("\n\n") == 19_999 and by[6] in ("", "deep text.")
    assert extraction.main_text(table.limit(0), extraction.fit_unlabelled(table.limit(0))).count() == 0


def test_trees():
    def tree(s):
        page = dom.parse(s)
        return [(page.kind[page.parent[i]], t) for i, t in enumerate(page.text) if t is not None]

    assert tree("<p>a<p>b<div>c</div>d") == [("p", "a"), ("p", "b"), ("div", "c"), ("body", "d")]
    assert tree("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>e") == [("li", "a"), ("li", "b"), ("li", "c"), ("li", "d"), ("body", "e")]
    assert tree("<table><tr><td>a<td>b<tr><th>c</table>d") == [("td", "a"), ("td", "b"), ("th", "c"), ("body", "d")]
    assert tree("<p>a <b>b</p>c</b><p>d</b> e") == [("p", "a b"), ("body", "c"), ("p", "d e")]
    assert tree("a<br>b <!-- x --> c<hr>d") == [("body", "a b c"), ("body", "d")]
    assert tree("<div class='top sidebar-left'>a</div><div id=main>b</div><DIV HIDDEN>c</DIV>") == [("SIDEBAR", "a"), ("CONTENT", "b"), ("HIDDEN", "c")]
    assert tree("1 < 2 <3> &lt;p> &amp;amp; </> x") == [("body", "1 < 2 <3> <p> &amp; x")]
    assert tree("<title>a</title><textarea><p>b</textarea>c") == [("body", "c")]
    assert tree("<head><title>a</title><p>b</head><body>c") == [("body", "c")]


def test_counts_add_up(spark):
    """Spark's sums over the tasks are those of one counter."""
    rows = [(i, extraction.layout(["a", "bb", "ccc"], i)) for i in range(40)]
    into: Counter = Counter()
    for _, s in rows:
        extraction.count_page(dom.parse(s, extraction.MARK), into)
    got = extraction.fit(spark.createDataFrame(rows, "page_id long, html string").repartition(7))
    assert got == extraction.Model.of(dict(into))
