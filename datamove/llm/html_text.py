"""The main text of web pages, by the ratio of text to tags.

The standard library's parser streams a page's events.  Each block of text is a line with a
ratio of characters to tags; the ratios are smoothed by a Gaussian, and a threshold parts the
lines of content from the rest.  Regions of the page that hold such lines are kept whole, whatever the markup calls them,
and no others are.  Of dense regions those go that the markup calls a menu, header, footer, sidebar, notice, advert, form
or comment, and where one of them is the page's article, those outside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from datamove.llm.arrow import map_texts

# Elements that start and end a block of text, fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)

# Elements without an end, fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# Elements whose text is never content, fixed values.
OUTSIDE = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noscript object option script select style svg template textarea title".split()
)

# Words in class, id or role that name something else than content, fixed values.
NAMES = frozenset(
    "ad ads advert advertisement alert banner breadcrumb breadcrumbs comment comments contentinfo cookie cookies copyright "
    "disclaimer disqus footer form header masthead menu modal nav navbar navigation newsletter notice pager pagination popup "
    "promo promoted related replies search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)

ARTICLES = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
REGIONS = ARTICLES | frozenset("aside body dialog div footer form header menu nav section table td".split())
CLOSES_P = BLOCKS - {"html", "body", "head"}
NAME = re.compile(r"[a-z]+")

# Standard deviation of the smoothing, in lines, and the threshold in deviations of the ratios.
SIGMA = 1.0
LAMBDA = 0.8


@dataclass
class Line:
    text: str
    tags: int
    region: int
    inside: bool
    article: bool


class Lines(HTMLParser):
    """Blocks of text with the tags in and before them, and the region they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Open elements: tag, whether all in it is outside the content, region, article.
        self.open: list[tuple[str, bool, int, bool]] = [("", False, 0, False)]
        self.lines: list[Line] = []
        self.data: list[str] = []
        self.tags = 0
        self.regions = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.data).split())
        self.data = []
        if text:
            _, outside, region, article = self.open[-1]
            self.lines.append(Line(text, self.tags, region, not outside, article))
            self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
        if tag == "br":
            self.data.append(" ")
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self._close("p", BLOCKS - {"p"})
        if tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
            self._close(tag, frozenset(("ul", "ol", "dl", "table", "select")))
        _, outside, region, article = self.open[-1]
        # An article's own headings stay, whatever they are called.
        named = self._named(tag, attrs) and not (article and tag in HEADINGS)
        outside = outside or tag in OUTSIDE or (tag == "header" and not article) or named
        if tag in REGIONS:
            self.regions += 1
            region = self.regions
        self.open.append((tag, outside, region, article or tag in ARTICLES))

    @staticmethod
    def _named(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in ("html", "body"):
            return False
        return any(
            (name in ("class", "id", "role") and not NAMES.isdisjoint(NAME.findall((value or "").lower())))
            or name == "hidden"
            or (name == "aria-hidden" and value == "true")
            for name, value in attrs
        )

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def _close(self, tag: str, until: frozenset[str]) -> None:
        """Close an open ``tag``, unless one of ``until`` was opened after it."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return
            if self.open[i][0] in until:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self.data.append(" ")
        # An inline element does not end a block that it stands in.
        self._close(tag, frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] not in ("script", "style"):
            self.data.append(data)

    def parse_html_declaration(self, i: int) -> int:
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def close(self) -> None:
        super().close()
        self._flush()


def reach(sigma: float) -> int:
    """Lines to either side that smoothing takes into account."""
    return max(1, int(np.ceil(3 * sigma)))


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    most = reach(sigma)
    kernel = np.exp(-(np.arange(-most, most + 1) ** 2) / (2 * sigma * sigma))
    return np.convolve(ratios, kernel / kernel.sum(), mode="full")[most:-most]


def content_blocks(html: str) -> list[str]:
    """Blocks of the main text in page order."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return []
    raw = np.array([len(line.text) / max(1, line.tags) for line in lines])
    ratios = smoothed(raw, SIGMA)
    threshold = LAMBDA * ratios.std()
    # Smoothing lifts the neighbours of content over the threshold; a line that makes a region
    # content must be over it by itself too.
    dense = {line.region for line, ratio in zip(lines, np.minimum(ratios, raw)) if ratio >= threshold}
    kept = [line for line in lines if line.inside and line.region in dense]
    article = [line for line in lines if line.inside and line.article]
    if article and len(article) <= reach(SIGMA):
        return [line.text for line in article]  # too few lines for ratios to tell
    if any(line.article for line in kept):
        kept = [line for line in kept if line.article]
    return [line.text for line in kept]


def extract_text(pages: DataFrame, keep: Sequence[str], *, html: str = "html") -> DataFrame:
    """The ``keep`` columns with ``text``, the main text of each page, its blocks parted by an empty line.

    Character references are decoded and white space in a block becomes one space; nothing is
    cut short.  Null and empty pages, and pages with nothing but menus and the like, have an empty
    text; a page of plain text is its own content.  Broken markup is read as the parser reads
    it.  Repeated pages are each extracted, and no page needs another.
    """

    def work(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            yield [pa.array(["\n\n".join(content_blocks(h.as_py() or "")) for h in column], pa.string())]

    return map_texts(pages, html, keep, [("text", "string")], work)
