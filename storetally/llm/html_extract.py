"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams events. Block elements cut a page into lines; scripts,
styles and the like hold none. Each line has a ratio of characters to tags. Text in a
*marked* container (menu, header, footer, sidebar, form, advert, notice or reader comments, known by its
element, its role, or a whole class or id) counts as markup: its ratio is 0. A mark by role, class, id or
form does not hold for a container with more than half of the page's characters, such as a form around the whole page.

The ratios are smoothed by a Gaussian, not across the borders of marked containers, and
split in two clusters at a border that is moved until it rests; if the clusters are not
clearly apart, all lines with a ratio are in the upper one. The upper cluster selects
the region: the articles (article, main) if they have at least three quarters of its lines,
else the smallest container of several lines that holds all of it. The text is the region's lines that are
in the upper cluster or in no marked container, so that a short paragraph is not lost. All lines
beside the region go, whatever they are called.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from storetally.llm.texts import table

# Elements and names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
NO_TEXT = frozenset(
    "head title script style noscript template button select textarea iframe object svg canvas".split()
)
MARKED = frozenset("nav footer aside menu header dialog".split())
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
MARKED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising ad-banner ad-slot sponsor sponsored promo banner nav navbar "
    "navigation menu sidebar footer site-footer page-footer site-header page-header masthead breadcrumb breadcrumbs "
    "cookie cookies cookie-banner cookie-consent cookie-notice consent notice notices alert popup modal newsletter "
    "subscribe subscription comment comments comment-list commentlist disqus disqus_thread share sharing social "
    "toolbar widget pagination pager".split()
)
COMMENT_NAMES = frozenset("comment comments comment-list commentlist disqus disqus_thread".split())
# Elements that a class or id can mark.
STRUCTURES = frozenset("div section ul ol dl table aside p article details figure center blockquote".split())
# Sections and quotes are parts of a text.
CONTAINERS = frozenset("article main div td body html".split())
WHOLE_PAGE = frozenset("html body main".split())
# Open elements that the start of another one ends, beside a paragraph.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SMOOTHING = 1.0
# Least ratio of the two clusters' means.
APART = 3.0
# Least share of the upper cluster's lines that makes the articles the region.
IN_ARTICLES = 0.75

_SPACE = re.compile(r"\s+")


class _Line(NamedTuple):
    text: str
    tags: int
    container: int
    article: int
    mark: int


class _Open(NamedTuple):
    """An open element, and what it and those around it make of the text in it."""

    tag: str
    silent: bool
    container: int
    article: int
    mark: int
    comment: bool


class _Page(HTMLParser):
    """Gathers the lines of a page. Every event takes the same time, however deep elements are nested or left open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.pieces: list[str] = []
        self.tags = 0
        self.open = [_Open("", False, 0, 0, 0, False)]
        self.counts: Counter[str] = Counter()
        # What is around each container and each mark; 0 is the page, and no mark.
        self.around = [0]
        self.marks = [0]
        self.firm = [False]

    def cut(self) -> None:
        """Ends the line."""
        if self.pieces:
            text = _SPACE.sub(" ", "".join(self.pieces)).strip()
            if text:
                now = self.open[-1]
                self.lines.append(_Line(text, max(1, self.tags), now.container, now.article, now.mark))
            self.pieces = []
        self.tags = 0

    def _push(self, element: _Open) -> None:
        self.open.append(element)
        self.counts[element.tag] += 1

    def _pop(self) -> None:
        self.counts[self.open.pop().tag] -= 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        found = {name: (value or "").lower() for name, value in attrs}
        hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "")
        now = self.open[-1]
        if tag in INLINE:
            if tag == "br":
                self.pieces.append(" ")
            elif hidden and tag not in VOID:
                self._push(now._replace(tag=tag, silent=True))
            return
        self.cut()
        if tag in VOID:
            return
        self._end_implied(tag)
        _, silent, container, article, mark, comment = self.open[-1]
        names = {*found.get("class", "").split(), found.get("id", "")} if tag in STRUCTURES else set()
        comment = comment or bool(names & COMMENT_NAMES)
        if tag in WHOLE_PAGE or (tag == "article" and not comment):
            # What is around these was not closed, or is the page.
            silent, mark = False, 0
        else:
            firm = hidden or (tag in MARKED and not (tag == "header" and article))
            if firm or tag == "form" or names & MARKED_NAMES or found.get("role", "") in MARKED_ROLES:
                self.marks.append(mark)
                self.firm.append(firm)
                mark = len(self.marks) - 1
        if tag in CONTAINERS:
            self.around.append(container)
            container = len(self.around) - 1
            if tag in ("article", "main") and not article and not comment:
                article = container
        self._push(_Open(tag, silent or tag in NO_TEXT, container, article, mark, comment))

    def _end_implied(self, tag: str) -> None:
        """A block ends an open paragraph, a list item or cell open ones of its kind, the body the head."""
        if tag == "body":
            while self.counts["head"]:
                self._pop()
        wanted = ENDS.get(tag, ())
        while self.open[-1].tag == "p" or self.open[-1].tag in wanted:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in INLINE:
            # Only hidden inline elements are kept open; they cannot end the block around them.
            if self.open[-1].tag == tag:
                self._pop()
            return
        self.cut()
        if self.counts[tag]:
            while self.open[-1].tag != tag:
                self._pop()
            self._pop()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("script", "style"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.open[-1].silent:
            self.pieces.append(data)

    def marked(self) -> list[bool]:
        """Of each line, whether it is in a marked container whose mark holds."""
        held = [0] * len(self.marks)
        for line in self.lines:
            held[line.mark] += len(line.text)
        # Marks are numbered from the outside in.
        for mark in range(len(held) - 1, 0, -1):
            held[self.marks[mark]] += held[mark]
        valid = [False] * len(held)
        for mark in range(1, len(held)):
            valid[mark] = valid[self.marks[mark]] or self.firm[mark] or 2 * held[mark] <= held[0]
        return [valid[line.mark] for line in self.lines]


def _smoothed(ratios: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Ratios smoothed by a Gaussian over the neighbours of the same part (runs of equal numbers)."""
    reach = int(3 * SMOOTHING)
    total, weights = np.zeros(len(ratios)), np.zeros(len(ratios))
    run = np.cumsum(np.diff(parts, prepend=parts[:1]) != 0)
    for step in range(-reach, reach + 1):
        weight = np.exp(-0.5 * (step / SMOOTHING) ** 2)
        here = np.arange(max(0, -step), min(len(ratios), len(ratios) - step))
        here = here[run[here] == run[here + step]]
        total[here] += weight * ratios[here + step]
        weights[here] += weight
    return total / weights


def clusters(ratios: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Lines of the upper of two clusters of smoothed ratios; all with a ratio if these are not `APART`."""
    smooth = _smoothed(ratios, parts)
    border = smooth.mean()
    for _ in range(20):
        upper = smooth >= border
        if upper.all():
            break
        moved = (smooth[upper].mean() + smooth[~upper].mean()) / 2
        if abs(moved - border) < 1e-9:
            break
        border = moved
    upper = (smooth >= border) & (smooth > 0)
    lower = ~upper & (smooth > 0)
    if lower.any() and smooth[upper].mean() < APART * smooth[lower].mean():
        upper = smooth > 0
    return upper


def _below(wanted: list[int], lines: list[int], around: list[int]) -> list[bool]:
    """Of each of `lines` (containers), whether it is below the smallest container of several lines that holds all of `wanted`."""
    # Containers are numbered from the outside in.
    counts, held = [0] * len(around), [0] * len(around)
    for container in lines:
        counts[container] += 1
    for container in wanted:
        held[container] += 1
    for container in range(len(around) - 1, 0, -1):
        counts[around[container]] += counts[container]
        held[around[container]] += held[container]
    region = max(c for c in range(len(around)) if held[c] == len(wanted) and (counts[c] > 1 or not c))
    inside = [False] * len(around)
    for container in range(region, len(around)):
        inside[container] = container == region or inside[around[container]]
    return [inside[container] for container in lines]


def main_text(html: str | None) -> str:
    """The text of the content lines, joined by line feeds; empty for a page without any."""
    if not html:
        return ""
    page = _Page()
    page.feed(html)
    page.close()
    page.cut()
    lines = page.lines
    if not lines:
        return ""
    marked = page.marked()
    ratios = np.array([0.0 if mark else len(line.text) / line.tags for line, mark in zip(lines, marked)])
    upper = clusters(ratios, np.array([line.mark if mark else 0 for line, mark in zip(lines, marked)]))
    if not upper.any():
        return ""
    chosen_articles = sum(line.article > 0 for line, chosen in zip(lines, upper) if chosen)
    if chosen_articles >= IN_ARTICLES * upper.sum():
        inside = [line.article > 0 for line in lines]
    else:
        wanted = [line.container for line, chosen in zip(lines, upper) if chosen]
        inside = _below(wanted, [line.container for line in lines], page.around)
    return "\n".join(
        line.text for line, here, chosen, mark in zip(lines, inside, upper, marked) if here and (chosen or not mark)
    )


def extract(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """`pages` with the main text of each whole page as a last column `name` (one that `pages` does not have).

    A NULL or empty page, and one without content, has an empty text. All rows
    stay, repeated ones too, with their other columns; an empty table stays empty.
    """
    place = pages.columns.index(html)
    schema = pages.selectExpr("*", f"'' AS `{name}`").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(one) for one in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, name])

    return pages.mapInArrow(run, schema)


def op7_html(spark, sf_dir: str) -> DataFrame:
    """Main text of all of `pages`."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).selectExpr("page_id", "url", "text", "CAST(length(text) AS bigint) AS n_chars")
