"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering.

The standard library's streaming parser turns a page into lines: one for each block of text, with its characters and the
tags met while it was read. Lines inside elements that are never content (menus, forms, scripts, adverts ..., by element
or by class, id or role, see ``_tells``) are left out; a form or a named element that wraps the page is not one of them. The ratio of text to tags of the other lines is smoothed
with a Gaussian over the page, and a threshold that splits the ratios into two clusters (their means in turn set the
threshold) selects content lines. If most of the selected text lies in one article or main element, the region is that
element with all of its lines, short ones too. Else lines are selected by the logarithms of their ratios, so that a long one
does not outweigh the others, and only say where the region is: in the innermost container that holds nearly all of them,
from the first to the last, and on to both sides up to lines that are mostly links (``_span``). All of its lines stay.

White space in a block becomes one space; blocks are joined by an empty line in page order. Null html is empty text.
Broken markup is read as the parser reads it; element ends that were never opened are ignored, and markup that nothing closes
is text, found in one pass over the page. Columns of ``carry`` named text or n_chars are replaced. Each page is on its own, so
repeated rows, ties and extra columns have no effect.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from outpour.llm.store import ship

# Elements of HTML by what they mean for this purpose.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_CONTENT = frozenset(
    "aside button canvas datalist dialog fieldset footer form head iframe input label menu nav noscript object option "
    "script select style svg template textarea title".split()
)
REGIONS = frozenset(["article", "main"])
NOT_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted "
    "related share sharing sidebar social sponsor sponsored subscribe widget".split()
)
# First parts of a name that make the rest say something else, such as has-sidebar or tag-advertising.
OTHER_SENSE = frozenset("cat category format has hide hides is no show shows status tag tags topic type with without".split())
# Words that also name a part of an article (post-header), and what comes before them where they do not.
OF_ARTICLES = frozenset(["header", "masthead"])
OF_PAGES = frozenset("blog global main page site top web".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OPENINGS = [("<!--", re.compile(r"--\s*>")), ("<![", re.compile(r"\]\s*>"))]
#: Elements that may hold the whole content of a page without article and main.
CONTAINERS = frozenset("html body div section center form td".split())
#: Share of the selected text that the content region of such a page holds at least.
SHARE = 0.75
#: Elements that their names never leave out.
WHOLE = frozenset(["html", "body", "main", "article"])


class Lines(HTMLParser):
    """Lines of a page: text, tags and the region each is in.

    Forms and elements left out by name are marks: whether they go is known when all of the page has been read. One that
    holds most of the page's text, and all text of its regions if there are any, wraps the page and stays.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.regions: list[int] = []
        self.containers: list[int] = []
        self.linked: list[int] = []  # characters inside links
        self.around = [0]  # container around each container; 0 is the page
        # Parts with the mark each is in and whether in a link; tags, region, container.
        self._lines: list[tuple[list[tuple[int, bool, str]], int, int, int]] = []
        self._outer = [0]  # mark around each mark; 0 is none
        # Element, whether it is left out; region, mark and container around it.
        self._open: list[tuple[str, bool, int, int, int]] = []
        self._text: list[tuple[int, bool, str]] = []
        self._tags = 0
        self._region = self._last_region = self._mark = self._container = self._links = 0

    def _end_line(self) -> None:
        if self._text:
            if any(text.strip() for *_, text in self._text):
                self._lines.append((self._text, self._tags, self._region, self._container))
                self._tags = 0
            self._text = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag in BLOCKS:
            self._end_line()
            if tag == "p":
                self._close("p")
        elif tag == "br":
            self._text.append((self._mark, False, " "))
        if tag in VOID:
            return
        left_out = bool(self._open) and self._open[-1][1]
        region, mark = self._region, self._mark
        if not left_out:
            left_out = tag in NEVER_CONTENT and tag != "form" or self._hidden(attrs) or (tag == "header" and not region)
            if not left_out and (tag == "form" or (tag not in WHOLE and self._named(tag, attrs))):
                self._outer.append(mark)
                mark = len(self._outer) - 1
            if tag in REGIONS and not region:
                self._last_region += 1
                region = self._last_region
        self._open.append((tag, left_out, self._region, self._mark, self._container))
        self._region, self._mark = region, mark
        self._links += tag == "a"
        if tag in CONTAINERS:
            self.around.append(self._container)
            self._container = len(self.around) - 1

    @staticmethod
    def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
        return any(name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attrs)

    @staticmethod
    def _named(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        names = [value.lower().split() for name, value in attrs if value and name in ("class", "id", "role")]
        return any(_tells(word, tag in HEADINGS) for own in names for word in own)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in BLOCKS:
            self._end_line()
        self._close(tag)

    def _close(self, tag: str) -> None:
        """Closes the innermost open element of this name and what is open inside; a p only within its block."""
        for k in range(len(self._open) - 1, -1, -1):
            name = self._open[k][0]
            if name == tag:
                self._region, self._mark, self._container = self._open[k][2:]
                self._links -= sum(element[0] == "a" for element in self._open[k:])
                del self._open[k:]
                return
            if tag == "p" and name in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if not (self._open and self._open[-1][1]):
            self._text.append((self._mark, self._links > 0, data))

    def _gone(self) -> list[bool]:
        """Whether what is in each mark is left out."""
        held, held_regions = [0] * len(self._outer), [0] * len(self._outer)
        for parts, _, region, _ in self._lines:
            for mark, _, text in parts:
                size = len("".join(text.split()))
                held[mark] += size
                held_regions[mark] += size if region else 0
        for mark in range(len(self._outer) - 1, 0, -1):  # inner marks come after the marks around them
            held[self._outer[mark]] += held[mark]
            held_regions[self._outer[mark]] += held_regions[mark]
        gone = [False]
        for mark in range(1, len(self._outer)):
            wraps = 2 * held[mark] > held[0] and held_regions[mark] == held_regions[0]
            gone.append(gone[self._outer[mark]] or not wraps)
        return gone

    def finish(self) -> None:
        self._end_line()
        gone, before = self._gone(), 0
        for parts, tags, region, container in self._lines:
            kept = [(linked, text) for mark, linked, text in parts if not gone[mark]]
            text = " ".join("".join(text for _, text in kept).split())
            before += tags
            if text:
                self.texts.append(text)
                self.tags.append(before)
                self.regions.append(region)
                self.containers.append(container)
                self.linked.append(sum(len("".join(text.split())) for linked, text in kept if linked))
                before = 0


def _tells(name: str, heading: bool) -> bool:
    """Whether a class, id or role says that an element is no content: as a whole, or by its first or last part.

    A part of a heading's name says nothing, nor does one in another sense, nor header where it is that of an article.
    """
    if name in NOT_CONTENT_WORDS:
        return True
    parts = [part for part in re.split(r"[-_]+", name) if part]
    if heading or len(parts) < 2 or parts[0] in OTHER_SENSE:
        return False
    return any(
        part in NOT_CONTENT_WORDS and (part not in OF_ARTICLES or parts[0] in OF_PAGES) for part in (parts[0], parts[-1])
    )


def _read(html: str) -> Lines:
    """The lines of a page, in time linear in it.

    The parser looks for the end of what is not closed once for each opening. So openings of comments and sections behind the last
    close of that kind become text before, and what follows the last > is text without being parsed.
    """
    for opening, closing in _OPENINGS:
        last = 0
        for found in closing.finditer(html):
            last = found.start()
        html = html[:last] + html[last:].replace(opening, "&lt;" + opening[1:])
    page, cut = Lines(), html.rfind(">") + 1
    page.feed(html[:cut])
    page.close()
    if cut < len(html):
        page.handle_data(unescape(html[cut:]))
    page.finish()
    return page


def main_text(html: str | None, smoothing: float = 1.0) -> str:
    """The main text of one page."""
    page = _read(html or "")
    if not page.texts:
        return ""
    size = np.fromiter(map(len, page.texts), np.float64, len(page.texts))
    region = np.array(page.regions)
    content = _content(size / np.maximum(np.array(page.tags), 1), smoothing)
    found = np.unique(region[region > 0])
    if len(found):
        inside = [size[content & (region == k)].sum() for k in found]
        whole = size[content].sum()
        # All regions that hold a share of the selected text, if together they hold most of it.
        if sum(inside) >= 0.5 * whole:
            largest = max(inside)
            own = [k for k, held in zip(found, inside) if held >= 0.25 * largest]
            return "\n\n".join(page.texts[k] for k in np.flatnonzero(np.isin(region, own)))
    start, stop = _span(page, size, _content(np.log1p(size / np.maximum(np.array(page.tags), 1)), smoothing))
    return "\n\n".join(page.texts[start:stop])


def _span(page: Lines, size: np.ndarray, content: np.ndarray) -> tuple[int, int]:
    """The lines of the content region of a page without article and main.

    The region is in the innermost container of two lines and more that holds SHARE of the selected text. It runs from the
    first to the last line selected there, and on to both sides as long as lines are in the container and not mostly links.
    """
    chosen, lines = np.zeros(len(page.around)), np.zeros(len(page.around), np.int64)
    np.add.at(chosen, page.containers, size * content)
    np.add.at(lines, page.containers, 1)
    for inner in range(len(page.around) - 1, 0, -1):  # inner containers come after those around them
        chosen[page.around[inner]] += chosen[inner]
        lines[page.around[inner]] += lines[inner]
    fits = [k for k in range(len(page.around)) if chosen[k] >= SHARE * chosen[0] and lines[k] > 1]
    region = max(fits, default=0)  # more than half of the text is in each, so they lie in one another
    inside = np.zeros(len(page.around), bool)
    for k in range(len(page.around)):
        inside[k] = k == region or (k > 0 and inside[page.around[k]])
    own = inside[page.containers]
    selected = np.flatnonzero(content & own)
    start, stop = int(selected[0]), int(selected[-1]) + 1
    solid = np.array([2 * linked <= len("".join(text.split())) for text, linked in zip(page.texts, page.linked)])
    while start > 0 and own[start - 1] and solid[start - 1]:
        start -= 1
    while stop < len(own) and own[stop] and solid[stop]:
        stop += 1
    return start, stop


def _content(ratio: np.ndarray, smoothing: float) -> np.ndarray:
    """Which lines are content: the upper of two clusters of the smoothed ratios."""
    reach = int(np.ceil(3 * smoothing))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / smoothing) ** 2)
    padded = np.pad(ratio, reach, mode="reflect" if len(ratio) > reach else "edge")
    smooth = np.convolve(padded, kernel / kernel.sum(), mode="valid")
    threshold = smooth.mean()
    for _ in range(50):
        upper = smooth >= threshold
        if upper.all():
            break
        new = (smooth[upper].mean() + smooth[~upper].mean()) / 2 if upper.any() else threshold
        if abs(new - threshold) < 1e-9:
            break
        threshold = new
    return smooth >= min(threshold, smooth.max())


def extract(pages: DataFrame, html_column: str, carry: list[str]) -> DataFrame:
    """The columns of ``carry`` with text and n_chars (code points)."""
    ship(pages.sparkSession)
    names = [name for name in carry if name not in ("text", "n_chars")]
    rows = pages.select(*[F.col(f"`{name}`") for name in names], F.col(html_column).cast("string").alias("__html"))
    kept = [field for field in rows.schema if field.name != "__html"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(html) for html in part.column(len(names)).to_pylist()]
            columns = [part.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, "text"])

    out = rows.mapInArrow(batches, StructType([*kept, StructField("text", StringType())]))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
