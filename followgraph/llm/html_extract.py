"""Main text of web pages by tag-path ratios.

A page is cut into blocks: stretches of text between block-level tags. Each block has a path,
the tags and class names from the root down to it. For every path the length of its text, its
punctuation marks and its link text are added up; their ratios to the number of its blocks
are smoothed over the blocks in page order (a Gaussian) and fused, with the ratios as they are,
to sections: paths down to the first paragraph, heading, list or table, so that short paragraphs
and headings stay with the long ones of their section. Every section stays whose fused ratio
passes a threshold, a part of the page's mean and `ENOUGH` at most; an article or main element is a
prior that raises its sections' ratios, if such elements hold most of the page's weight. Paths
that are mostly link text go.

Menus, headers, footers, sidebars, notices, adverts, scripts, styles and reader comments are known
by tag, by role or by words in class and id, and give no weight and no text. Words in class and id
inside an article or main element, and form elements, are a prior only: what they
condemn comes back if it is a text of `A_TEXT` characters and weighs `BELIEF` times what they leave
(a page builder's `widget` around the article, a form around the page), and meets the threshold then.

Defined results for odd input: null, empty or text-free pages give an empty text; broken
markup is read as a browser would (unclosed paragraphs end at the next block, unknown closing
tags are ignored); very long and deeply nested pages are read whole, in time that grows with
their length; repeated rows give repeated rows. Only the
html column is read; the column `text` that `extract` adds replaces one of the same name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed word lists.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img".split())
NO_TEXT = frozenset("script style noscript template iframe object svg canvas head title math audio video".split())
BOILERPLATE = frozenset("nav header footer aside button select option textarea input label fieldset dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar menu nav navbar navigation"
    " breadcrumb breadcrumbs header masthead footer comment comments disqus reply replies respond notice cookie cookies consent gdpr popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended recommendations widget toolbar pagination pager"
    " disclaimer alert aside paywall copyright".split()
)
LAYOUT = frozenset("has with without no wrapper".split())
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th figure figcaption".split())

_PART = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
_MARKS = re.compile(r"[.,;:!?…。，；：！？¿¡]")


class Path:
    """Tags and class names from the root down, one object for each different path."""

    __slots__ = ("below", "section", "article", "leaf")

    def __init__(self, tag: str = "", up: Path | None = None):
        self.below: dict[str, Path] = {}
        self.leaf = up is not None and (up.leaf or tag in LEAVES)
        self.article = up is not None and (up.article or tag in ("article", "main"))
        #: the path down to the first paragraph, heading, list or table
        self.section = up.section if self.leaf else self

    def to(self, tag: str, name: str) -> Path:
        found = self.below.get(name)
        if found is None:
            found = self.below[name] = Path(tag, self)
        return found


class _Element:
    __slots__ = ("tag", "up", "path", "out", "by_name", "doubt")

    def __init__(self, tag: str, attrs: dict[str, str], up: _Element | None, root: Path):
        self.tag, self.up = tag, up
        self.by_name: frozenset = frozenset(("form",)) if tag == "form" else frozenset()
        self.out = tag in NO_TEXT or tag in BOILERPLATE
        self.doubt: int | None = None
        name = tag
        if attrs:
            names = attrs.get("class") or ""
            words = {w.lower() for w in _PART.findall(f"{names} {attrs.get('id') or ''}")}
            name = ".".join([tag, *sorted(names.split())])
            # "has-sidebar" and the like tell of a layout, not of what stands in the element
            if tag not in ("html", "body") and not words & LAYOUT:
                self.by_name |= words & NAMES
            hidden = (
                "hidden" in attrs
                or (attrs.get("aria-hidden") or "").lower() == "true"
                or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()
            )
            self.out = self.out or hidden or (attrs.get("role") or "").lower() in ROLES
        around = up.path if up else root
        self.path = around if tag in INLINE else around.to(tag, name)

    @property
    def condemned(self) -> bool:
        return self.out or bool(self.by_name)

    def own_doubt(self) -> int:
        if self.out or self.by_name & COMMENTS:
            return OUT
        return (NAMED if self.by_name - {"form"} else FORM) if self.by_name else CLEAN


#: How much is held against a block: nothing, a form around it, a telling name, a veto.
CLEAN, FORM, NAMED, OUT = range(4)


def _doubt(element: _Element | None) -> int:
    """The most that is held against an element or one around it; kept with the elements, so
    that all blocks of a page cost one step an element."""
    chain = []
    while element is not None and element.doubt is None:
        chain.append(element)
        element = element.up
    worst = element.doubt if element is not None else CLEAN
    for e in reversed(chain):
        worst = e.doubt = max(worst, e.own_doubt())
    return worst


class Block:
    """A stretch of text, the element it stands in, and how much of it is link text."""

    __slots__ = ("text", "inside", "path", "linked")

    def __init__(self, text: str, inside: _Element | None, path: Path, linked: int):
        self.text, self.inside, self.path, self.linked = text, inside, path, linked


class _Blocks(HTMLParser):
    """Keeps the places of open elements by tag, so that no step looks through all of them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Path()
        self.open: list[_Element] = []
        self.places: dict[str, list[int]] = {}
        self.solid: list[int] = []  # places of what is not inline
        self.named: list[_Element] = []  # open elements with telling names, less comments
        self.done: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.seen_article = False

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            inside = self.open[-1] if self.open else None
            self.done.append(Block(text, inside, inside.path if inside else self.root, self.linked))
        self.parts, self.linked = [], 0

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, k: int) -> None:
        while len(self.open) > k:
            element = self.open.pop()
            self.places[element.tag].pop()
            if element.tag not in INLINE:
                self.solid.pop()
            if self.named and self.named[-1] is element:
                self.named.pop()

    def pop_to(self, tags, stop=frozenset()) -> None:
        k = self.last(tags)
        if k > self.last(stop):
            if self.solid and self.solid[-1] >= k:
                self.flush()
            self.cut(k)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self.pop_to({"p"}, {"button", "td", "th", "table", "object"})
        if tag in CLOSES_OWN:
            self.pop_to(CLOSES_OWN[tag], {"ul", "ol", "dl", "table", "select"})
        element = _Element(tag, dict(attrs), self.open[-1] if self.open else None, self.root)
        if tag not in INLINE or element.condemned:
            self.flush()
        if tag in VOID:
            return
        if tag == "main" or (tag == "article" and not self.seen_article and not element.by_name):
            self.seen_article = True
            for outer in self.named:  # a layout's class like "with-sidebar" doesn't condemn the article in it
                outer.by_name = frozenset()
            self.named = []
        self.places.setdefault(tag, []).append(len(self.open))
        if tag not in INLINE:
            self.solid.append(len(self.open))
        if element.by_name and not element.by_name & COMMENTS:
            self.named.append(element)
        self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag):
        if tag == "br":
            self.flush()
        elif self.places.get(tag):
            k = self.places[tag][-1]
            solid = bool(self.solid) and self.solid[-1] >= k
            if tag in INLINE and solid:
                return  # a style's end can't close the block it stands in
            if solid or any(e.condemned for e in self.open[k:]):
                self.flush()
            self.cut(k)

    def handle_data(self, data):
        self.parts.append(data)
        if self.places.get("a"):
            self.linked += len(data.strip())


def blocks_of(html: str) -> list[Block]:
    reader = _Blocks()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.done


#: A fused ratio that is enough on any page, and what an article or main element multiplies it by.
ENOUGH, PRIOR = 60.0, 8.0
#: Names and forms are believed unless what they condemn weighs so many times what they leave
#: and is a text of so many characters.
BELIEF, A_TEXT = 20.0, 500


def _path_ratios(blocks: list[Block]) -> dict[Path, float]:
    """Text per block, times punctuation per block and one, of every path."""
    length, marks, count = {}, {}, {}
    for b in blocks:
        length[b.path] = length.get(b.path, 0) + len(b.text)
        marks[b.path] = marks.get(b.path, 0) + len(_MARKS.findall(b.text))
        count[b.path] = count.get(b.path, 0) + 1
    return {at: length[at] / count[at] * (1 + marks[at] / count[at]) for at in count}


def _weight(blocks: list[Block]) -> float:
    ratio = _path_ratios(blocks)
    return sum(ratio[b.path] * len(b.text) for b in blocks)


def _section_ratios(blocks: list[Block], width: float = 1.0) -> tuple[dict[Path, float], dict[Path, int]]:
    """Text and punctuation per block of the paths, as they are and smoothed in page order, fused
    by section; and the text of each section."""
    by_path = _path_ratios(blocks)
    ratio = [by_path[b.path] for b in blocks]
    reach = int(3 * width)
    kernel = [math.exp(-0.5 * (k / width) ** 2) for k in range(-reach, reach + 1)]
    fused: dict[Path, float] = {}
    size: dict[Path, int] = {}
    for i, b in enumerate(blocks):
        near = [(kernel[j - i + reach], ratio[j]) for j in range(max(0, i - reach), min(len(blocks), i + reach + 1))]
        smooth = sum(w * r for w, r in near) / sum(w for w, _ in near)
        at = b.path.section
        fused[at] = fused.get(at, 0.0) + math.sqrt(smooth * ratio[i]) * len(b.text)
        size[at] = size.get(at, 0) + len(b.text)
    return {at: fused[at] / size[at] for at in fused}, size


def _kept_sections(blocks: list[Block], least: float) -> set[Path]:
    """Sections whose fused ratio passes the threshold."""
    ratios, size = _section_ratios(blocks)
    weights = {at: ratios[at] * size[at] for at in ratios}
    total = sum(weights.values())
    most = 2 * sum(w for at, w in weights.items() if at.article) > total
    threshold = min(least * total / sum(size.values()), ENOUGH)
    return {at for at, ratio in ratios.items() if ratio * (PRIOR if most and at.article else 1.0) >= threshold}


def _unlinked(blocks: list[Block], links: float) -> list[Block]:
    """Without menus of links, which have no part in the page's mean either."""
    length, linked = {}, {}
    for b in blocks:
        length[b.path] = length.get(b.path, 0) + len(b.text)
        linked[b.path] = linked.get(b.path, 0) + b.linked
    return [b for b in blocks if linked[b.path] <= links * length[b.path]]


def _believed(blocks: list[Block], links: float) -> list[Block]:
    """Blocks with nothing held against them; names inside an article or main element, and forms
    around a page, are a prior against a block only, which the weight of the text can overrule."""
    doubts = [_doubt(b.inside) for b in blocks]
    left = [d <= FORM or (d == NAMED and b.path.article) for b, d in zip(blocks, doubts)]
    clean = _unlinked([b for b, d in zip(blocks, doubts) if d == CLEAN], links)
    doubted = _unlinked([b for b, d, ok in zip(blocks, doubts, left) if ok and d > CLEAN], links)
    if sum(len(b.text) for b in doubted) < A_TEXT or _weight(doubted) <= BELIEF * _weight(clean):
        return clean
    return _unlinked([b for b, ok in zip(blocks, left) if ok], links)


def main_text(html: str | None, least: float = 0.15, links: float = 0.5) -> str:
    """The main text's blocks in page order, joined by one blank."""
    if not html:
        return ""
    blocks = _believed(blocks_of(html), links)
    if not blocks:
        return ""
    sections = _kept_sections(blocks, least)
    return " ".join(b.text for b in blocks if b.path.section in sections)


def main_text_column(html: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([main_text(h) for h in series], dtype=object)

    return F.pandas_udf(run, "string")(html.cast("string"))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """All columns of `pages`, and `text`."""
    return pages.withColumn("text", main_text_column(F.col(html)))
