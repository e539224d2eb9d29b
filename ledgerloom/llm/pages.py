"""Main text of web pages from text-to-tag ratios.

The page streams through the standard library's HTML parser. Its events give lines: the text between two block
boundaries, with the number of tags on the way. Elements that say what they are (menus, forms, comments, ..) give none. The
ratio of text to tags per line is smoothed with a Gaussian, and lines above one standard deviation of the ratios are content;
neighbouring ones form a cluster. The ``article`` or ``main`` element that holds the clusters is the article: all its lines are
taken, so a short paragraph isn't lost. Where there is none, all lines of the page are, without those that are links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import carried, restored

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
#: Never part of an article, whatever is inside.
_HARD_TAGS = set(
    "head title script style noscript template svg math canvas iframe object audio video nav aside footer header menu dialog select "
    "button textarea datalist map".split()
)
_HARD_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promos promotion comment comments disqus reply "
    "replies respond related recommended recommendations share sharing social newsletter subscribe subscription cookie cookies "
    "consent gdpr popup modal overlay lightbox hidden".split()
)
#: Such a wrapper may still hold the article; then the article element counts.
_SOFT_WORDS = set(
    "nav navbar navigation menu menus sidebar side aside footer foot header masthead banner breadcrumb breadcrumbs notice notices alert "
    "alerts warning toolbar topbar pagination pager login signin signup register search form widget widgets copyright legal disclaimer "
    "skip meta tags".split()
)
_ROLES = set("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar form toolbar".split())
_MAIN = {"article", "main"}
_HOLDERS = _MAIN | set("body section div td table center blockquote".split())
_BREAKS_ITEM = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}


class _Line:
    __slots__ = ("text", "tags", "linked", "path")

    def __init__(self, text: str, tags: int, linked: int, path: tuple[int, ...]):
        self.text, self.tags, self.linked, self.path = text, tags, linked, path


#: Never shown as text. What else stands in a head is none of it: browsers move it to the body.
_UNSEEN_TAGS = set("title script style template iframe audio video canvas datalist".split())


class LineParser(HTMLParser):
    """Parser events to lines of text; ``holders`` maps the number of a container to its tag.

    With ``visible`` only what a reader doesn't see is left out, boilerplate is not. ``title`` is the first title of the page,
    ``links`` the number of anchors that lead somewhere; comments, scripts and the like hold none.
    """

    def __init__(self, visible: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self._visible = visible
        self.lines: list[_Line] = []
        self.holders = {0: "page"}
        self._open: list[tuple[str, int, int | None]] = []  # tag, how surely no content (0 to 2), container number
        self._parts: list[str] = []
        self._tags = self._linked = self.links = 0
        self._title: list[str] | None = None
        self._titled = False

    @property
    def title(self) -> str:
        return " ".join("".join(self._title or []).split())

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in _INLINE:
            self._end_line()
        self._tags += 1
        self.links += tag == "a" and any(name == "href" for name, _ in attrs)
        if tag == "title" and self._title is None:
            self._title, self._titled = [], True
        if tag in _VOID:
            return
        if tag not in _INLINE:
            self._imply_end(tag)
        self._open.append((tag, self._boiler(tag, dict(attrs)), self._hold(tag)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # In HTML the slash means nothing but on void elements.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self._titled = self._titled and tag != "title"
        if tag not in _INLINE:
            self._end_line()
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                del self._open[i:]
                return
            if tag in _INLINE and self._open[i][0] not in _INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self._titled:
            self._title.append(data)
        if not self._open or not self._open[-1][1]:
            self._parts.append(data)
            if any(tag == "a" for tag, *_ in self._open[-4:]):
                self._linked += len(data)

    def close(self) -> None:
        super().close()
        self._end_line()

    def _hold(self, tag: str) -> int | None:
        if tag not in _HOLDERS:
            return None
        self.holders[len(self.holders)] = tag
        return len(self.holders) - 1

    def _boiler(self, tag: str, attrs: dict[str, str | None]) -> int:
        above = self._open[-1][1] if self._open else 0
        if self._visible:
            if tag in ("html", "body"):
                return 0
            unseen = tag in _UNSEEN_TAGS or "hidden" in attrs or tag == "dialog" and "open" not in attrs
            return 2 if above or unseen or re.search(r"display\s*:\s*none", attrs.get("style") or "", re.I) else 0
        names = [set(re.findall(r"[a-z]+", x)) for x in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()]
        # "with-sidebar" says what the whole page has beside the text.
        words = set().union(*[n for n in names if not n & {"with", "has", "no", "without"}])
        if tag in ("html", "body"):
            return 0
        if tag in _HARD_TAGS or words & _HARD_WORDS or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return 2
        if re.search(r"display\s*:\s*none", attrs.get("style") or "", re.I):
            return 2
        if tag in _MAIN:
            return 2 if above == 2 else 0
        if tag == "form" or attrs.get("role") in _ROLES or words & _SOFT_WORDS:
            return max(1, above)
        return above

    def _imply_end(self, tag: str) -> None:
        """A block ends an open paragraph, an item the item before it."""
        if tag in ("html", "body", "head"):
            if tag == "body":
                self._open = [x for x in self._open if x[0] not in ("head", "title")]
            return
        ends, stop = ({tag}, _BREAKS_ITEM[tag]) if tag in _BREAKS_ITEM else ({"p"}, _HOLDERS)
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] in ends:
                del self._open[i:]
                return
            if self._open[i][0] in stop or self._open[i][0] in _HOLDERS:
                return

    def _end_line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            path = (0, *[h for _, _, h in self._open if h is not None])
            self.lines.append(_Line(text, self._tags, self._linked, path))
            self._tags = 0
        self._parts, self._linked = [], 0


def _events(html: str, visible: bool = False) -> LineParser:
    try:
        return _fed(html, visible)
    except AssertionError:  # the parser gives up on broken <![ sections; read them as comments that end at the next >, as browsers do
        return _fed(re.sub(r"<!\[[^>]*>?", "", html), visible)


def _fed(html: str, visible: bool) -> LineParser:
    parser = LineParser(visible)
    for i in range(0, len(html), 1 << 16):
        parser.feed(html[i : i + (1 << 16)])
    parser.close()
    return parser


def content_lines(lines: list[_Line], sigma: float = 1.0) -> np.ndarray:
    """Whether the smoothed text-to-tag ratio of a line is at least one standard deviation of the ratios."""
    ratio = np.array([(len(x.text) - x.linked) / max(1, x.tags) for x in lines])
    reach = np.arange(-2, 3)
    kernel = np.exp(-(reach**2) / (2 * sigma**2))
    smooth = np.convolve(ratio, kernel, "full")[2:-2] / np.convolve(np.ones(len(ratio)), kernel, "full")[2:-2]
    return smooth >= min(ratio.std(), smooth.max())


def main_text(html: str | None) -> str:
    """The text of the article: white space collapsed, blocks in page order joined by one space. NULL gives none."""
    parser = _events(html or "")
    lines = parser.lines
    if not lines:
        return ""
    chosen = content_lines(lines)
    weight: dict[int, int] = {}
    for x, good in zip(lines, chosen):
        for h in x.path if good else ():
            weight[h] = weight.get(h, 0) + len(x.text)
    best = 0
    # From the page down to the article element that holds all of the content.
    while parser.holders[best] not in _MAIN:
        inner = {x.path[x.path.index(best) + 1] for x in lines if best in x.path[:-1]}
        heavy = max(inner, key=lambda h: (weight.get(h, 0), -h), default=None)
        if heavy is None or weight.get(heavy, 0) < weight[best]:
            best = 0  # no article holds it all, and other containers may be a part of one
            break
        best = heavy
    inside = [i for i, x in enumerate(lines) if best in x.path]
    if parser.holders[best] not in _MAIN:
        mains = {h for i in inside for h in lines[i].path if parser.holders[h] in _MAIN}
        held = sum(len(lines[i].text) for i in inside if chosen[i] and mains & set(lines[i].path))
        if 2 * held > weight[best]:  # articles hold the content: what stands outside them is none
            inside = [i for i, x in enumerate(lines) if mains & set(x.path)]
        else:  # short lines belong to the article unless they are links
            inside = [i for i in inside if chosen[i] or 2 * lines[i].linked < len(lines[i].text)]
    return " ".join(lines[i].text for i in inside)


def extracted(pages: DataFrame, page: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row ``(page, *keep, text)`` per page; ``text`` is empty for NULL, empty and article-less pages.

    The whole page is read. Rows with the same id are extracted each on its own. Broken mark-up is read as far as it
    goes. Of the other columns only those of ``keep`` are read, and passed on. An empty table gives none.
    """

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="html").assign(text=[main_text(h) for h in batch["html"]])

    held = [carried(c).alias(f"k{i}") for i, c in enumerate(keep)]
    found = pages.select(carried(page).alias("doc"), *held, F.col(html).alias("html"))
    found = found.mapInPandas(extract, ", ".join(["doc string", *[f"k{i} string" for i in range(len(keep))], "text string"]))
    return found.select(restored(pages, page), *[restored(pages, c, f"k{i}") for i, c in enumerate(keep)], "text")
