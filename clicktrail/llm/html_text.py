"""The main text of web pages, from the density of text between tags.

The standard library's parser streams events; every block of the page becomes a line with its text and the
number of tags since the line before.  The ratios of text to tags are smoothed with a Gaussian, and a
threshold in units of their deviation separates content lines from the rest.  Lines inside elements that are
never content (menus, forms, adverts ...) count as empty.  The clusters of dense lines select the content
region: the smallest element that holds nearly all of their text, widened to the article it lies in or to
parents that add only prose.  All lines of the region stay, so headings, lists and verse do.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clicktrail.llm.words import chunks

SIGMA = 1.0
RADIUS = 3
THRESHOLD = 0.5  # standard deviations of the smoothed ratios
EDGE_RATIO = 5.0  # characters for each tag that a line at the end of a cluster needs
REGION_SHARE = 0.8  # of the characters of dense lines, for the element that is the region

# HTML's elements by how they are laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPTIONAL_END = frozenset("p li dt dd tr td th option".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead title tr ul".split()
)
NEVER = frozenset(
    "script style noscript template svg math iframe object canvas audio video select button textarea form nav footer aside title dialog"
    " menu".split()
)
CONTAINER = frozenset(("article", "main"))
REGION = CONTAINER | {"section", "div", "center"}
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figcaption hgroup tr caption summary".split())
# Words of class, id and role attributes that mark what is not content.
BOILERPLATE = frozenset(
    "nav navbar navigation menu menubar footer contentinfo sidebar aside complementary ad ads adv advert adverts advertisement adsense adbox"
    " sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login"
    " search social share sharing related recommended recommendations comment comments disqus breadcrumb breadcrumbs pagination pager"
    " widget toolbar copyright disclaimer skip".split()
)
PAGE_HEADER = frozenset("header masthead banner".split())
# Words after such a word that only say what kind of box it is in, and words before it that say it is elsewhere.
WRAPPER = frozenset(
    "box block container wrapper wrap inner outer bar list links link section area panel buttons button items item form slot unit"
    " posts articles stories text content title".split()
)
ELSEWHERE = frozenset("has no with without".split())
LISTED = frozenset("li dt dd tr".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNFINISHED = re.compile(r"<[A-Za-z/!?][^>]*\Z")


def says(name: str, words: frozenset[str]) -> bool:
    """Whether a class or id is one of ``words``, or has it as its last part (``main-nav``, ``share-box``; not ``related-work``)."""
    if name.lower() in words:
        return True
    parts = [p.lower() for p in _WORD.findall(name) if len(p) > 1]
    if ELSEWHERE.intersection(parts):
        return False
    while len(parts) > 1 and parts[-1] in WRAPPER:
        parts.pop()
    return bool(parts) and parts[-1] in words


@dataclass(slots=True)
class Line:
    text: str  # empty: something without content was here
    tags: int = 0
    linked: int = 0  # characters of links
    links: int = 0
    element: int = 0  # the innermost element that could be a region; 0 is the page
    block: str = ""

    @property
    def is_menu(self) -> bool:
        return 2 * self.linked > len(self.text) and (self.links > 1 or self.block in LISTED)

    @property
    def is_prose(self) -> bool:
        return self.block in PROSE and not self.is_menu


class Lines(HTMLParser):
    """Collects the blocks that are not inside an element without content, and the tree of elements that could be regions."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []  # element, and whether it has no content
        self.counts: Counter[str] = Counter()  # of open elements
        self.closed = 0  # how many open elements have no content
        self.around: list[int] = [0]  # open regions
        self.parents, self.tags_of = [-1], [""]  # of regions, which are numbered as they begin
        self.block = ""
        self.in_link = False
        self.words: list[str] = []
        self.linked = self.links = self.tags = 0
        self.lines: list[Line] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words.clear()
        if text:
            self.lines.append(Line(text, self.tags, self.linked, self.links, self.around[-1], self.block))
            self.tags = 0
        elif self.closed and (not self.lines or self.lines[-1].text):
            self.lines.append(Line(""))  # what was left out keeps its neighbours apart
        self.linked = self.links = 0

    def _unwanted(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        inside = self.counts["article"] or self.counts["main"]
        if tag in NEVER or (tag == "header" and not inside):
            return True
        if tag in ("body", "html"):
            return any(name == "hidden" for name, _ in attrs)
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if value and name in ("class", "id", "role"):
                # Articles often say that they have comments; only a name of their own makes them such.
                if tag in CONTAINER:
                    if BOILERPLATE.intersection(value.lower().split()):
                        return True
                elif any(says(x, BOILERPLATE) or (not inside and says(x, PAGE_HEADER)) for x in value.split()):
                    return True
        return False

    def _pop(self) -> None:
        tag, unwanted = self.open.pop()
        self.counts[tag] -= 1
        self.closed -= unwanted
        if tag in REGION:
            self.around.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
            self.block = tag
            self.in_link = False
        elif tag == "a":
            self.in_link = True
            self.links += 1
        elif tag in ("br", "td", "th") and not self.closed:
            self.words.append(" ")
        if tag in VOID:
            return
        while self.open and (self.open[-1][0] == "title" or (tag in BLOCK and self.open[-1][0] in OPTIONAL_END and tag in OPTIONAL_END | {self.open[-1][0]})):
            self._pop()
        if tag in CONTAINER:
            while self.counts["nav"] or self.counts["header"]:  # neither can hold an article
                self._pop()
        unwanted = self._unwanted(tag, attrs) if attrs or tag in NEVER or tag == "header" else False
        if tag in OPTIONAL_END and not unwanted:
            return
        self.open.append((tag, unwanted))
        self.counts[tag] += 1
        self.closed += unwanted
        if tag in REGION:
            self.parents.append(self.around[-1])
            self.tags_of.append(tag)
            self.around.append(len(self.parents) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
            self.block = ""
        if tag in BLOCK or tag == "a":
            self.in_link = False
        if self.counts[tag]:
            while self.open[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data: str) -> None:
        if not self.closed:
            self.words.append(data)
            self.linked += len(data) * self.in_link


def parsed(html: str) -> Lines:
    parser = Lines()
    parser.feed(_UNFINISHED.sub("", html))
    parser.close()
    parser.end_line()
    return parser


def dense(lines: list[Line]) -> np.ndarray:
    """Which lines' smoothed ratios of text to tags reach the threshold.

    Smoothing also lifts what stands beside a cluster; lines of links at its ends are given back.
    """
    ratio = np.array([len(x.text) / max(1, x.tags) for x in lines])
    x = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-0.5 * (x / SIGMA) ** 2)
    smooth = np.convolve(ratio, kernel / kernel.sum(), "full")[RADIUS : RADIUS + len(ratio)]
    # With little spread no line stands out: all have the page's density.
    limit = min(THRESHOLD * smooth.std(), smooth.max() / 2)
    full = np.array([bool(x.text) for x in lines])
    picked = (smooth >= limit) & full
    own = ratio >= min(limit, EDGE_RATIO)
    for order in (range(len(lines)), range(len(lines) - 1, -1, -1)):
        inside = False
        for k in order:
            inside = picked[k] and (inside or own[k])
            picked[k] = inside
    return picked if picked.any() else full


class Tree:
    """The elements that could be regions.  They are numbered as they begin, so a subtree is a range of numbers."""

    def __init__(self, page: Lines):
        self.parents, self.tags = page.parents, page.tags_of
        self.last = list(range(len(self.parents)))
        for e in range(len(self.parents) - 1, 0, -1):
            self.last[self.parents[e]] = max(self.last[self.parents[e]], self.last[e])

    def summed(self, weights: np.ndarray) -> np.ndarray:
        """Every element's weight with all below it."""
        total = weights.copy()
        for e in range(len(total) - 1, 0, -1):
            total[self.parents[e]] += total[e]
        return total

    def outermost(self, tag: str) -> np.ndarray:
        """The outermost element of this tag around every element, itself included; 0 if there is none."""
        found = np.zeros(len(self.parents), np.int64)
        for e in range(1, len(found)):
            found[e] = found[self.parents[e]] or (e if self.tags[e] == tag else 0)
        return found

    def children(self, region: int) -> np.ndarray:
        """The child of ``region`` that every element lies in; ``region`` if in none."""
        found = np.full(len(self.parents), region)
        for e in range(region + 1, self.last[region] + 1):
            found[e] = e if self.parents[e] == region else found[self.parents[e]]
        return found


def content(page: Lines) -> list[str]:
    """The lines of the content region, in page order."""
    lines, tree = page.lines, Tree(page)
    picked = dense(lines)
    size = np.array([len(x.text) for x in lines])
    element = np.array([x.element for x in lines])
    count = len(tree.parents)
    weight = tree.summed(np.bincount(element, size * picked, count))
    region = int(np.flatnonzero(weight >= REGION_SHARE * weight[0])[-1])  # such elements are one path down
    articles = tree.outermost("article")
    whole = int(articles[region] or tree.outermost("main")[region])
    full = size > 0

    def within(e: int) -> np.ndarray:
        return (element >= e) & (element <= tree.last[e]) & full

    if whole:
        keep = within(whole)
    else:
        # Parents that add nothing but prose belong to it.
        odd = tree.summed(np.bincount(element, [bool(x.text) and not x.is_prose for x in lines], count))
        while region and (up := tree.parents[region]) and odd[up] == odd[region]:
            region = up
        keep = within(region)
        # Parts of it that are mostly links, and links at its ends, are menus.
        chars = tree.summed(np.bincount(element, size, count))
        linked = tree.summed(np.bincount(element, [x.linked for x in lines], count))
        child = tree.children(region)
        keep &= ~((child != region) & (2 * linked[child] > chars[child]))[element]
        if not region:
            # The page itself is content from the prose before its dense lines to the prose behind them.
            stops = np.array([not x.is_prose for x in lines]) & full
            at = np.flatnonzero(picked)
            before, after = np.flatnonzero(stops[: at[0]]), np.flatnonzero(stops[at[-1] + 1 :])
            keep[: before[-1] + 1 if len(before) else 0] = False
            keep[at[-1] + 1 + after[0] if len(after) else len(lines) :] = False
        text = np.flatnonzero(keep & ~np.array([x.is_menu for x in lines]))
        if len(text):
            keep[: text[0]] = keep[text[-1] + 1 :] = False
    for a in np.unique(articles[element[picked]]):  # articles with dense lines are content wherever they lie
        if a:
            keep |= within(a)
    return [lines[k].text for k in np.flatnonzero(keep)]


def main_text(html: str | None) -> str:
    """The blocks of the main text, joined by newlines; empty for null, empty and text-free pages."""
    page = parsed(html) if html else None
    return "\n".join(content(page)) if page and any(x.text for x in page.lines) else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``.

    Null and empty html give an empty text.  An unfinished tag at the end is not text.  Repeated rows are
    each extracted; other columns are not read.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            out = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(texts, "page_id long, url string, text string, n_chars long")
