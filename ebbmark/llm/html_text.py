"""Main text of HTML pages by text-to-tag ratios.

A streaming parser turns a page into lines, one per block, each with its text,
its tags and the regions (article, section, div, ...) it lies in. The ratio of
text to tags per line is smoothed with a Gaussian; lines above a threshold taken
from the spread of the ratios are the core, and the smallest region that holds
nearly all of it is where the article lies. The outermost article or main element
around that region is the article; without one, the region grows outwards as long
as what it takes in is mostly lines of core by their own ratios. All lines of the
article are the text, except parts that are menus, adverts, forms and the like: by
their element, by a name that says nothing else, by their links, or by a name that
may mean it where ratios or links agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.llm.arrays import texts_of
from ebbmark.llm.columns import others

SMOOTHING = 1.0
# Share of the core that the region holds from which the article is looked for.
CORE_SHARE = 0.9
# Share of core, by their own ratios, in the lines that a larger region takes in.
GROWTH_SHARE = 0.8
# A part whose name may mean a menu or advert is one with more of its text in links, or less of it core.
DOUBTFUL_LINKS = 1 / 3
DOUBTFUL_CORE = 0.5
# A part of the article with so many links, and so much of its text in them, is a menu.
MENU_LINKS = 3
MENU_SHARE = 2 / 3

# Fixed values of the HTML standard: elements without an end, elements that
# begin a block, elements whose content is not text of the page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
UNSEEN = set(
    "annotation annotation-xml aside audio button canvas datalist dialog fieldset footer form head iframe input menu nav noframes "
    "noscript object option script search select style svg template textarea title video".split()
)
REGIONS = set("article body center div main section table td".split())
# Regions that can be menus. A table of linked names is content.
MENUS = set("center div section td".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Names (class, id, role) of parts that are not the article.
BOILERPLATE = set(
    "ad ads adsense advert adverts advertisement alert banner breadcrumb breadcrumbs comment commentlist comments "
    "complementary consent "
    "contentinfo cookie cookies dialog disqus footer gdpr login masthead menu modal nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promoted promotion recommended related replies reply respond share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
# Words that say where or what shape a part is, not what it holds.
NEUTRAL = set(
    "area bar block bottom box button buttons col column container content footer global group holder icons inner item "
    "items left link links list main outer page panel post posts primary right row secondary section site slot small "
    "text title top wrap wrapper".split()
)
HEADER_NAMES = {"header", "banner", "site-header", "page-header", "topbar", "top-bar"}


class _Lines(HTMLParser):
    """Lines of a page: ``text``, ``tags``, ``path`` (regions, outermost first), ``shown``, characters in links and links.

    ``region_tags`` has the element of each region, ``doubtful`` the regions whose
    name may mean that they are no content.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Open elements: tag, whether its content is left out, its region number or None.
        self.open: list[tuple[str, bool, int | None]] = []
        self.hidden = 0
        self.region_tags = [""]
        self.doubtful: set[int] = set()
        self.path: tuple[int, ...] = ()
        self.found: list[tuple[str, int, tuple[int, ...], bool, int, int]] = []
        self.parts: list[str] = []
        self.tags = 0
        self.in_links = self.link_chars = self.links = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.found.append((text, self.tags, self.path, self.hidden == 0, self.link_chars, self.links))
            self.tags = 0
        self.parts = []
        self.link_chars = self.links = 0

    def _pop_to(self, place: int) -> None:
        for tag, left_out, region in self.open[place:]:
            self.hidden -= left_out
            self.in_links -= tag == "a"
            if region is not None:
                self.path = self.path[:-1]
        del self.open[place:]

    def _left_out(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
        """Whether an element is surely no content, and whether its name leaves that in doubt."""
        if tag in UNSEEN:
            return True, False
        if tag == "header":
            return not any(t in ("article", "main") for t, _, _ in self.open), False
        if tag in ("html", "body", "main") or tag in HEADINGS:
            return False, False
        doubtful = False
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True, False
            if name == "style" and "display:none" in value.replace(" ", ""):
                return True, False
            if name in ("class", "id", "role"):
                for word in value.split():
                    parts = word.replace("_", "-").split("-")
                    if word in HEADER_NAMES and tag != "article":
                        return True, False
                    # "no-sidebar" is said of the part beside which there is none.
                    if parts[0] in ("no", "has", "with", "without") or BOILERPLATE.isdisjoint(parts):
                        continue
                    # "social-history" or "market-share" say something of their own.
                    if all(p in BOILERPLATE or p in NEUTRAL or not p or p.isdigit() for p in parts):
                        return True, False
                    doubtful = True
        return False, doubtful

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag in BLOCKS
        if block:
            self._end_line()
            # A paragraph, and an item of the same list, ends where the next block begins.
            for place in range(len(self.open) - 1, -1, -1):
                open_tag = self.open[place][0]
                if open_tag == "p" or (open_tag == tag and tag in ("li", "dd", "dt", "option", "tr", "td", "th")):
                    self._pop_to(place)
                    break
                if open_tag in BLOCKS:
                    break
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "wbr", "img"):
                self.parts.append(" " if tag != "wbr" else "")
            return
        left_out, doubtful = self._left_out(tag, attrs)
        if left_out and not block and not self.hidden and "".join(self.parts).strip():
            # Hidden inline content must not run into the text around it.
            self.parts.append(" ")
        region = None
        if tag in REGIONS or (doubtful and block):
            region = len(self.region_tags)
            self.region_tags.append(tag)
            self.path += (region,)
            if doubtful:
                self.doubtful.add(region)
        self.hidden += left_out
        if tag == "a":
            self.in_links += 1
            self.links += 1
        self.open.append((tag, left_out, region))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._end_line()
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == tag:
                self._pop_to(place)
                return
            if tag not in BLOCKS and self.open[place][0] in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        if self.hidden:
            # Counts as a line of its own kind: its text is no content.
            if any(t in BLOCKS and out for t, out, _ in self.open):
                self.parts.append(data)
            return
        if self.in_links:
            self.link_chars += len(" ".join(data.split()))
        self.parts.append(data)


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    reach = int(3 * SMOOTHING)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SMOOTHING) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def main_text(html: str) -> str:
    """The article of a page, its blocks joined by two line breaks."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser._end_line()
    lines = parser.found
    shown = np.array([line[3] for line in lines], bool)
    if not shown.any():
        return ""
    lengths = np.array([len(line[0]) for line in lines], float) * shown
    own = lengths / np.maximum([line[1] for line in lines], 1)
    ratios = _smoothed(own)
    threshold = min(ratios.std(), 0.5 * ratios[shown].max())
    core = shown & (ratios > threshold)
    if not core.any():
        core = shown
    # A short line beside long ones is only core by its neighbours.
    firm = core & (own > threshold) if (core & (own > threshold)).any() else core
    held = _by_region(lines, lengths * core)
    # Numbers grow inwards and onwards: the last region with enough of the core is the smallest.
    dense = max((region for region, n in held.items() if n >= CORE_SHARE * lengths[core].sum()), default=0)
    around = next((path[: path.index(dense) + 1] for _, _, path, *_ in lines if dense in path), ())
    article = next((region for region in around if parser.region_tags[region] in ("article", "main")), 0)
    all_of, firm_of = _by_region(lines, lengths), _by_region(lines, lengths * firm)
    if not article:
        article = dense
        for outer in reversed(around[:-1]):
            if firm_of[outer] - firm_of.get(article, 0) < GROWTH_SHARE * (all_of[outer] - all_of[article]):
                break
            article = outer
    # Parts by their links and names; what holds the dense region is none.
    linked_of = _by_region(lines, np.array([line[4] for line in lines], float) * shown)
    links_of = _by_region(lines, np.array([line[5] for line in lines], float) * shown)
    gone = set()
    for region, n in all_of.items():
        if region <= article or region in around or not n:
            continue
        menu = parser.region_tags[region] in MENUS and links_of[region] >= MENU_LINKS and linked_of[region] > MENU_SHARE * n
        agreed = region in parser.doubtful and (linked_of[region] > DOUBTFUL_LINKS * n or firm_of[region] < DOUBTFUL_CORE * n)
        if menu or agreed:
            gone.add(region)
    kept = [
        text
        for text, _, path, seen, *_ in lines
        if seen and (not article or article in path) and gone.isdisjoint(path)
    ]
    return "\n\n".join(kept)


def _by_region(lines: list[tuple], values: np.ndarray) -> dict[int, float]:
    """Sum of the lines' values for every region they lie in."""
    sums: dict[int, float] = {}
    for line, value in zip(lines, values.tolist(), strict=True):
        for region in line[2]:
            sums[region] = sums.get(region, 0.0) + value
    return sums


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the article of each page, and ``n_chars``, its code points.

    A null, empty or text-free page has an empty text; unclosed elements end
    with their parents; repeated rows are read one by one; columns named like
    a result, in any case, are replaced; an empty table gives no rows.
    """
    rows = pages.select(*others(pages, ["text", "n_chars"]))
    place = rows.columns.index("html")
    out = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(html.as_py()) for html in texts_of(batch.column(place))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=out.names)

    return rows.mapInArrow(extracted, out).withColumn("n_chars", F.char_length("text").cast("bigint"))
