"""Main text of web pages by a tree-structured graphical model over their elements.

A page is a tree (``dom``) of elements with blocks of text as leaves; every node is content or not.
The potential between a parent and a child is the probability of the child's label given its
parent's and what the child is: its tag, or what its class, id or role call it.  The potential of a
node is the likelihood of what is seen of it: of a block, its length, share of links, end and place,
given the element it is in; of an element, its share of the page and number of blocks.  Sum-product message passing, from the leaves up and from the root down, gives each node's exact
marginal; blocks whose marginal of being content is above one half are the text, in page order.

Both kinds of potentials are counts over labelled pages, added up by Spark; the table has a few hundred
entries, whatever the number of pages.  ``fit`` takes any pages in which ``data-main`` marks elements
as content (1) or not (0).  The query has no labels, so it makes labelled pages from a bounded sample
of about ``TRAIN_PAGES`` pages, picked by hash: the words of each are laid out anew in one of many layouts
whose parts are known, and a page with a single ``article`` is also taken as it stands, what that holds
being content but for its own menus, asides, forms and the like.

Text is whole: character references are decoded, white space within a block becomes one space,
blocks are joined by a blank line; scripts, styles, and other elements never shown are left out.

Defined cases: null or empty html, and pages without content, give an empty text; repeated rows and null
ids are rows like any other; elements left open or cut off are closed at the end; pages are read whole,
however long or deep; only the three named columns are read, whatever others are called; an
empty table gives an empty result.  Without a page to learn from the layouts use one made-up word.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import read_table, small_batches
from crestline.llm.dom import Page, parse

TRAIN_PAGES = 4_000
MARK = "data-main"
PRIOR = 2.0  # pseudo-counts that a kind's table has of all kinds' table
WEIGHT = 0.5  # of what is seen of a node, as its parts depend on each other
EVIDENCE = 4.0  # and as the blocks of a page do, they weigh no more than so many together
RESULT = "page_id long, url string, text string, n_chars long, n_blocks int"
_SENTENCE = (".", "!", "?", "…", "。", "”", '"', ":")
_NOT_CONTENT = {"nav", "aside", "footer", "form", "button", "NAV", "SIDEBAR", "FOOTER", "FORM", "AD", "COMMENT", "NOTICE", "SHARE", "RELATED", "HIDDEN"}


def _log(n: float) -> int:
    return min(int(math.log2(n + 1)), 12)


def observations(page: Page) -> tuple[list[list[tuple]], list[int], list[int]]:
    """What is seen of each node, its characters, and its blocks."""
    count = len(page.parent)
    chars, linked, blocks, sentences = [0] * count, [0] * count, [0] * count, [0] * count
    depth = [0] * count
    for i in range(count):
        if page.parent[i] >= 0:
            depth[i] = depth[page.parent[i]] + 1
    for i in range(count - 1, -1, -1):
        if page.text[i] is not None:
            chars[i], linked[i], blocks[i] = len(page.text[i]), page.linked[i], 1
            sentences[i] = int(page.text[i].endswith(_SENTENCE))
        p = page.parent[i]
        if p >= 0:
            chars[p] += chars[i]
            linked[p] += linked[i]
            blocks[p] += blocks[i]
            sentences[p] += sentences[i]
    out, before = [], 0
    for i in range(count):
        share = 4 * linked[i] // chars[i] if chars[i] else -1
        place = 4 * before // chars[0] if chars[0] else 0
        if page.text[i] is not None:
            before += chars[i]
            within = page.kind[page.parent[i]]
            out.append([(f"{name} in {within}", v) for name, v in (("chars", _log(chars[i])), ("links", share), ("end", sentences[i]), ("place", place))])
        elif chars[i]:
            out.append([("part", 4 * chars[i] // chars[0]), ("blocks", _log(blocks[i]))])
        else:
            out.append([])
    return out, chars, blocks


def labels(page: Page) -> list[int]:
    """Content or not, as marked: an element is what half of its characters are, a block what it lies in."""
    count = len(page.parent)
    own, good, chars = [0] * count, [0] * count, [0] * count
    for i in range(count):
        p = page.parent[i]
        mark = page.label[i]
        own[i] = int(mark == "1") if mark in ("0", "1") else own[p] if p >= 0 else 0
    for i in range(count - 1, -1, -1):
        if page.text[i] is not None:
            chars[i], good[i] = len(page.text[i]), own[i] * len(page.text[i])
        p = page.parent[i]
        if p >= 0:
            chars[p] += chars[i]
            good[p] += good[i]
    return [own[i] if not chars[i] else int(2 * good[i] >= chars[i]) for i in range(count)]


def label_by_article(page: Page) -> bool:
    """Mark a page that has exactly one article by it."""
    at = [i for i, k in enumerate(page.kind) if k == "article"]
    if len(at) != 1:
        return False
    inside = [False] * len(page.kind)
    for i in range(at[0], len(page.kind)):
        inside[i] = i == at[0] or inside[page.parent[i]]
        if inside[i] and i != at[0] and page.kind[i] in _NOT_CONTENT:
            page.label[i] = "0"
    page.label[at[0]] = "1"
    return True


def edge_kinds(page: Page) -> list[str]:
    """What tells the potential of each node and its parent: its kind, and the parent's if no content."""
    return [k if p < 0 or page.kind[p] not in _NOT_CONTENT else f"{k} in {page.kind[p]}" for k, p in zip(page.kind, page.parent)]


def count_page(page: Page, into: Counter) -> None:
    """Add a labelled page: (kind, parent's label, label) and (what is seen, value, label)."""
    seen, chars, _ = observations(page)
    y = labels(page)
    for i, kind in enumerate(edge_kinds(page)):
        p = page.parent[i]
        if chars[i] or page.text[i] is not None:
            into["edge", kind, str(y[p] if p >= 0 else 1), y[i]] += 1
            for name, value in seen[i]:
                into["node", name, str(value), y[i]] += 1


@dataclass(frozen=True)
class Model:
    """Probabilities of labels by kind and parent's label, and log likelihood ratios of what is seen."""

    edges: dict[str, tuple[float, float]]  # of being content: in a parent that is not, in one that is
    nodes: dict[tuple[str, int], float]  # log p(seen | content) - log p(seen | not)
    other: tuple[float, float]

    @classmethod
    def of(cls, counts: dict[tuple, int]) -> Model:
        def total(**fixed) -> float:
            at = [("what", "key", "value", "y").index(n) for n in fixed]
            return sum(n for k, n in counts.items() if all(k[a] == v for a, v in zip(at, fixed.values())))

        other = tuple((total(what="edge", value=p, y=1) + 1) / (total(what="edge", value=p) + 2) for p in "01")
        edges = {}
        for kind in {k[1] for k in counts if k[0] == "edge"}:
            edges[kind] = tuple(
                (counts.get(("edge", kind, p, 1), 0) + PRIOR * o)
                / (counts.get(("edge", kind, p, 1), 0) + counts.get(("edge", kind, p, 0), 0) + PRIOR)
                for p, o in zip("01", other)
            )
        nodes = {}
        for name in {k[1] for k in counts if k[0] == "node"}:
            values = {k[2] for k in counts if k[:2] == ("node", name)}
            whole = [total(what="node", key=name, y=y) for y in (0, 1)]
            for v in values:
                share = [(counts.get(("node", name, v, y), 0) + 1) / (whole[y] + len(values) + 1) for y in (0, 1)]
                nodes[name, int(v)] = math.log(share[1] / share[0])
        return cls(edges, nodes, other)


def marginals(page: Page, model: Model) -> list[float]:
    """Probability of each node of being content, by messages up and down the tree."""
    seen, chars, blocks = observations(page)
    count = len(page.parent)
    leaf = min(WEIGHT, EVIDENCE / max(blocks[0], 1))
    edges = [model.edges.get(k) or model.edges.get(k.split()[0], model.other) for k in edge_kinds(page)]
    up0, up1 = [0.0] * count, [0.0] * count  # log of what a node and all below it say of its label
    to0, to1 = [0.0] * count, [0.0] * count  # its message to the parent, by the parent's label
    for i in range(count - 1, -1, -1):
        up1[i] += (WEIGHT if page.text[i] is None else leaf) * sum(model.nodes.get(x, 0.0) for x in seen[i])
        if not chars[i]:
            continue  # holds no text, says nothing
        e0, e1 = edges[i]
        high = max(up0[i], up1[i])
        a, b = math.exp(up0[i] - high), math.exp(up1[i] - high)
        to0[i] = math.log((1 - e0) * a + e0 * b) + high
        to1[i] = math.log((1 - e1) * a + e1 * b) + high
        p = page.parent[i]
        if p >= 0:
            up0[p] += to0[i]
            up1[p] += to1[i]
    out, odds = [0.0] * count, [0.0] * count  # odds as logarithms
    for i in range(count):
        if not chars[i]:
            continue
        p = page.parent[i]
        e0, e1 = edges[i]
        # The parent's belief without what this child told it.
        one = _share(odds[p] - (to1[i] - to0[i])) if p >= 0 else 1.0
        top0, top1 = (1 - one) * (1 - e0) + one * (1 - e1), (1 - one) * e0 + one * e1
        odds[i] = up1[i] - up0[i] + math.log(top1) - math.log(top0)
        out[i] = _share(odds[i])
    return out


def _share(odds: float) -> float:
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def extract(source: str | None, model: Model) -> list[str]:
    """The blocks of a page that are content."""
    if not source:
        return []
    page = parse(source)
    likely = marginals(page, model)
    return [t for t, p in zip(page.text, likely) if t is not None and p > 0.5]


class _Layout:
    """Pages with known parts, from the words of a page; the same for the same seed."""

    def __init__(self, words: list[str], seed: int):
        self.words, self.at = words or ["word"], 0
        self.pick = random.Random(seed)

    def some(self, least: int, most: int, end: str = "") -> str:
        n = self.pick.randint(least, most)
        out = []
        for _ in range(n):
            out.append(self.words[self.at % len(self.words)])
            self.at += 1
        return " ".join(out).rstrip(".,") + end

    def maybe(self, share: float) -> bool:
        return self.pick.random() < share

    def box(self, body: str, *choices: str, mark: str = "") -> str:
        """An element, given as tag and attributes; now and then its name says nothing."""
        start = self.pick.choice(choices)
        tag = start.split()[0]
        if tag == "div" and self.maybe(0.15):
            start = f'div class="x{self.pick.randint(1, 99)}"'
        return f"<{start}{mark}>{body}</{tag}>"

    def links(self, least: int = 3, most: int = 9) -> str:
        items = [f'<a href="/{i}">{self.some(1, 4)}</a>' for i in range(self.pick.randint(least, most))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.maybe(0.7) else " | ".join(items)

    def paragraph(self) -> str:
        most = self.pick.choice([3, 8, 30, 90])
        text = " ".join(self.some(1, most, self.pick.choice(".....!?")) for _ in range(self.pick.randint(1, 5)))
        if self.maybe(0.2):
            text += f' <a href="/">{self.some(1, 3)}</a> {self.some(1, 9, ".")}'
        if self.maybe(0.15):
            return f"<p><b>{text}<br>"
        return f"<p>{text}" + ("</p>" if self.maybe(0.9) else "")

    def block(self) -> str:
        kind = self.pick.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.8:
            return f"<h2>{self.some(1, 7)}</h2>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{self.some(1, 20, self.pick.choice(['', '.']))}</li>" for _ in range(self.pick.randint(2, 6))) + "</ul>"
        if kind < 0.9:
            return f"<blockquote>{self.paragraph()}</blockquote>"
        if kind < 0.93:
            return f"<pre>{self.some(3, 40)}</pre>"
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{self.some(1, 3)}</td><td>{self.some(1, 9)}</td></tr>" for _ in range(3)) + "</table>"
        return f'<figure><img src="x"><figcaption>{self.some(3, 14, ".")}</figcaption></figure>'

    def aside(self) -> str:
        """A part that is not content and may stand anywhere."""
        return self.pick.choice([self.advert, self.sharing, self.related, self.sign_up, self.notice])()

    def advert(self) -> str:
        return self.box(" ".join(self.some(2, self.pick.choice([8, 60]), ".") for _ in range(self.pick.randint(1, 3))), 'div class="ad"', 'div class="advert box"', 'div id="ad-top"', 'div class="sponsored"', 'aside class="promo"')

    def sharing(self) -> str:
        return self.box(self.links(2, 5), 'div class="share"', 'div class="social-links"', 'ul class="sharing"')

    def related(self) -> str:
        return self.box(f"<h3>{self.some(1, 3)}</h3>" + self.links(), 'div class="related"', 'aside', 'section class="more-stories"', 'div class="recommended"')

    def sign_up(self) -> str:
        return self.box(f'<label>{self.some(1, 5)}</label><input name="q"><button>{self.some(1, 2)}</button>' + (f"<p>{self.some(4, 15, '.')}</p>" if self.maybe(0.4) else ""), "form", 'form class="newsletter"', 'div class="search-form"', 'div class="login"')

    def notice(self) -> str:
        return self.box(f"{self.paragraph()}<button>{self.some(1, 2)}</button>", 'div class="cookie-notice"', 'div id="consent"', 'div role="alert"', 'div class="banner"', 'section class="gdpr"')

    def side(self) -> str:
        return self.box("".join(self.box(f"<h4>{self.some(1, 3)}</h4>" + self.pick.choice([self.links(), self.paragraph()]), "div", 'div class="widget"') for _ in range(self.pick.randint(1, 3))), "aside", 'div class="sidebar"', 'div id="right-col"', 'div class="rail"')

    def comments(self) -> str:
        each = [self.box(f"<b>{self.some(1, 2)}</b> " + "".join(self.paragraph() for _ in range(self.pick.randint(1, 3))), "li", 'div class="comment"', "article") for _ in range(self.pick.randint(1, 6))]
        return self.box(f"<h3>{self.some(1, 3)}</h3>" + "".join(each), 'section id="comments"', 'div class="comments"', 'ol class="commentlist"', 'div class="discussion"')

    def foot(self) -> str:
        return self.box(self.pick.choice([f"&copy; {self.some(2, 16, '.')}", self.paragraph() + self.links(), self.links()]), "footer", "footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"')

    def page(self) -> str:
        has = self.maybe
        parts = []
        if has(0.4):
            parts.append(self.box(self.pick.choice([f"<h1>{self.some(1, 4)}</h1>", f"<p>{self.some(1, 9)}</p>", self.links()]), "header", 'div class="header"', 'div id="masthead"'))
        if has(0.8):
            parts.append(self.box(self.links(), "nav", "nav", 'div class="menu"', 'ul id="navigation"', 'div class="breadcrumbs"'))
        parts += [self.aside() for _ in range(self.pick.randint(0, 2))]
        if has(0.25):
            parts.append(self.side())
        blocks = [self.block() for _ in range(self.pick.choice([0, 1, 3, 8, 20]))]
        body = "".join([f"<h1>{self.some(1, 10)}</h1>", self.paragraph(), *blocks])
        no = f' {MARK}="0"'
        if has(0.3):
            at = self.pick.randint(0, len(body)) if not blocks else 0
            extra = f"<div{no}>{self.aside()}</div>" if has(0.5) else self.aside().replace(">", f"{no}>", 1)
            body = extra + body if at == 0 and has(0.3) else body + extra
        if has(0.2):
            body += self.comments().replace(">", f"{no}>", 1)
        body = self.box(body, "article", "article", "article", "main", 'div class="content"', 'div id="main"', 'div class="post-body"', "section", 'div class="article-body"', "div", "td", mark=f' {MARK}="1"')
        if has(0.3):
            body = self.box(body, "main", "div", 'div class="container"', 'div id="page"', "section")
        parts.append(body)
        if has(0.3):
            parts.append(self.comments())
        if has(0.25):
            parts.append(self.side())
        parts += [self.aside() for _ in range(self.pick.randint(0, 1))]
        if has(0.8):
            parts.append(self.foot())
        return "<body>" + "".join(parts) + "</body>"


def layout(words: list[str], seed: int) -> str:
    return _Layout(words, seed).page()


def _added(rows: DataFrame) -> dict[tuple, int]:
    """Sums of counted rows: one for each kind or value and label, a few hundred."""
    got = rows.groupBy("what", "key", "value", "y").agg(F.sum("n").alias("n")).collect()
    return {(r.what, r.key, r.value, r.y): r.n for r in got}


def _count_rows(counts: Counter) -> pa.RecordBatch:
    cols = list(zip(*[(*k, n) for k, n in counts.items()])) or [()] * 5
    types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["what", "key", "value", "y", "n"])


_COUNTS = "what string, key string, value string, y int, n long"


def fit(labelled: DataFrame, html: str = "html") -> Model:
    """A model of labelled pages, whose elements ``data-main`` marks as content (1) or not (0)."""
    small_batches(labelled.sparkSession)

    def count(batches):
        into: Counter = Counter()
        for b in batches:
            for source in b.column(0).to_pylist():
                if source:
                    count_page(parse(source, MARK), into)
        yield _count_rows(into)

    return Model.of(_added(labelled.select(F.col(html).alias("html")).mapInArrow(count, _COUNTS)))


def fit_unlabelled(pages: DataFrame, html: str = "html", most: int = TRAIN_PAGES) -> Model:
    """A model from the words of about ``most`` pages laid out anew, and from pages with one article."""
    small_batches(pages.sparkSession)
    named = pages.select(F.col(html).alias("html"))
    n = named.count()
    mark = F.xxhash64("html")
    some = named.select("html", mark.alias("seed")).where(F.pmod(mark, F.lit(max(1, -(-n // most)))) == 0)

    def learn(source: str | None, seed: int, into: Counter) -> None:
        page = parse(source or "")
        words = [w for t in page.text if t for w in t.split()][:20_000]
        for i in range(max(1, 2000 // n if n else 2000)):
            count_page(parse(layout(words, seed + i), MARK), into)
        if label_by_article(page):
            count_page(page, into)

    def count(batches):
        into: Counter = Counter()
        for b in batches:
            for source, seed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                learn(source, seed, into)
        yield _count_rows(into)

    counts = _added(some.mapInArrow(count, _COUNTS))
    if not counts:
        alone: Counter = Counter()
        learn("", 0, alone)
        counts = dict(alone)
    return Model.of(counts)


def main_text(pages: DataFrame, model: Model, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page, as in ``RESULT``."""
    small_batches(pages.sparkSession)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks = [extract(s, model) for s in b.column("html").to_pylist()]
            texts = ["\n\n".join(x) for x in blocks]
            sizes = [pa.array([len(t) for t in texts], pa.int64()), pa.array([len(x) for x in blocks], pa.int32())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), *sizes], names=["page_id", "url", "text", "n_chars", "n_blocks"])

    named = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return named.mapInArrow(run, RESULT)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return main_text(pages, fit_unlabelled(pages))


# No SQL passes messages, but it can cut out the one article that every page of the test tables has: what
# the model has to find there.  Blocks are headings and paragraphs; five character references occur.
ARTICLES_SQL = r"""
WITH cut AS (
  SELECT page_id, url, regexp_split_to_array(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '</?(?:p|h1)>') AS parts
  FROM pages
), plain AS (
  SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&#39;', chr(39)), '&amp;', '&'),
    '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks
  FROM cut
)
SELECT page_id, url, array_to_string(blocks, chr(10) || chr(10)) AS text,
       CAST(length(array_to_string(blocks, chr(10) || chr(10))) AS BIGINT) AS n_chars, CAST(len(blocks) AS INTEGER) AS n_blocks
FROM plain"""
