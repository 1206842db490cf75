"""Pages as trees of blocks: what the text extractor needs of HTML, tolerant of what is left open."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# What the HTML standard calls void, raw text, and phrasing; what ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head template svg math object audio video canvas datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dt dd".split()
)
# An element that starts ends an open one of the second kind, unless one of the third is nearer.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tr", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "tbody"}, {"table"}),
}

# What the words of class, id and role say an element is, the first that fits.
HINTS = {
    "hidden": "hidden noscript d-none visually-hidden sr-only",
    "comment": "comment comments commentlist comment-list discussion disqus replies reply respond",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog paywall banner",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsbygoogle dfp",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs crumbs toc pagination pager tabs topics tags",
    "sidebar": "sidebar side aside rail widget widgets complementary right-col left-col secondary",
    "share": "share sharing social follow subscribe newsletter signup",
    "related": "related recommended recommendations more trending popular read-next also teaser teasers",
    "form": "form search login searchbox contact",
    "footer": "footer foot copyright legal colophon contentinfo imprint bottom",
    "header": "header head masthead top topbar logo site-title branding",
    "content": "article content post entry story main body text entry-content post-content article-body articlebody "
    "main-content post-body story-body maincontent hentry",
}
_HINT = {w: (rank, kind) for rank, (kind, words) in enumerate(HINTS.items()) for w in words.split()}
KNOWN = frozenset(
    "body article main section div p span ul ol li dl dt dd table tbody thead tr td th h1 h2 h3 h4 h5 h6 nav aside "
    "header footer form fieldset button label select option blockquote pre figure figcaption details summary center address".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z|[\"'][^>]*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Page:
    """Nodes in page order, each after its parent; a leaf is one block of text."""

    parent: list[int] = field(default_factory=list)
    kind: list[str] = field(default_factory=list)  # what it is: a hint of its names, or its tag; "text" for leaves
    text: list[str | None] = field(default_factory=list)  # of leaves
    linked: list[int] = field(default_factory=list)  # characters of a leaf that lie in links
    label: list[str | None] = field(default_factory=list)  # of marked elements in labelled pages

    def add(self, parent: int, kind: str, text: str | None = None, linked: int = 0, label: str | None = None) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return len(self.parent) - 1


def kind_of(tag: str, attributes: dict[str, str]) -> str:
    """A hint's name in capitals, or the tag."""
    if "hidden" in attributes or tag == "noscript" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return "HIDDEN"
    best = None
    for name in ("role", "id", "class", "itemprop"):
        for word in attributes.get(name, "").lower().split():
            # The whole name, its words joined, or else each of its words.
            parts = _WORD.findall(word)
            for w in ["-".join(parts), "".join(parts)] if len(parts) > 1 else parts:
                found = _HINT.get(w)
                if found and (best is None or found < best):
                    best = found
            if len(parts) > 1:
                for w in parts:
                    found = _HINT.get(w)
                    if found and (best is None or found < best):
                        best = found
    if best:
        return best[1].upper()
    return tag if tag in KNOWN else "other"


def parse(source: str, mark: str | None = None) -> Page:
    """The tree of a page; ``mark`` names an attribute that labels elements in training."""
    page = Page()
    page.add(-1, "body")
    stack: list[tuple[str, int]] = [("body", 0)]
    run: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                page.add(stack[-1][1], "text", text, min(linked, len(text)))
            run.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal links
        if any(page_node != stack[to - 1][1] for _, page_node in stack[to:]):
            flush()
        for tag, _ in stack[to:]:
            links -= tag == "a"
        del stack[to:]

    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        piece = source[at : found.start()] if found else source[at:]
        if piece:
            run.append(piece)
            if links:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        tag = found.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if found.group(1):
            if tag in ("body", "html") or tag in VOID:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    pop(i)
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break  # an inline end does not close blocks
            continue
        if not found.group(0).endswith(">"):
            break  # a tag that the page breaks off in
        if tag in RAW or tag in UNSEEN:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            if tag not in INLINE and tag not in ("script", "style", "title", "head"):
                flush()
            if close is None and tag == "head":
                close = re.compile(r"(?=<body[\s>])", re.I).search(source, at)
                if close is None:
                    continue
            at = close.end() if close else end
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in ("body", "html") or tag in VOID and tag != "hr":
            continue
        if tag in ENDS_P or tag in ENDS:
            ends, unless = ENDS.get(tag, (set(), set()))
            if tag in ENDS_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        pop(i)
                        break
                    if stack[i][0] in ("button", "td", "th", "caption", "table"):
                        break
            last = None
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in unless:
                    break
                if stack[i][0] in ends:
                    last = i
            if last is not None:
                pop(last)
        if tag == "hr":
            flush()
            continue
        if found.group(3).rstrip().endswith("/") and tag not in KNOWN and tag not in INLINE:
            continue
        if tag in INLINE:
            links += tag == "a"
            stack.append((tag, stack[-1][1]))
            continue
        flush()
        attributes = {k.lower(): a or b or c or "" for k, a, b, c in _ATTRIBUTE.findall(found.group(3))}
        label = attributes.get(mark) if mark else None
        stack.append((tag, page.add(stack[-1][1], kind_of(tag, attributes), label=label)))
    flush()
    return page
