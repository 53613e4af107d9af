"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page as events. Text between two block
boundaries is a line; its ratio is the number of its characters per tag met on
the way to it. Ratios of all lines of the page are smoothed with a Gaussian, and
lines above the threshold (the standard deviation of the smoothed ratios, as
long as nothing else is stated) form clusters. The element that holds the
clusters is the content region: an article or main element with most of their
text, or else the deepest element with nearly all of it. Of the region all lines
stay, also short ones, but for parts that are boilerplate by their tag, role or
name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Standard deviation of the Gaussian, in lines, and the threshold in standard deviations of the smoothed ratios.
SIGMA = 1.0
LEVEL = 1.0
# Shares of the clusters' text that make an article or any other element the region.
ARTICLE_SHARE, OTHER_SHARE = 0.5, 0.95
# Characters of a page that the parser gets at a time.
FEED = 1 << 16

# Fixed values of HTML: which elements break lines, are empty, hold no readable text or end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead "
    "title tr ul".split()
)
CELL = frozenset("td th br img".split())
SILENT = frozenset(
    "script style head title noscript template iframe object svg math canvas audio video map select textarea button input datalist "
    "nav menu aside form dialog search".split()
)
WRITTEN = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt tr figcaption".split())
IMPLIED_END = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select datalist"),
}
IMPLIED_END = {tag: (frozenset(ends.split()), frozenset(stops.split())) for tag, (ends, stops) in IMPLIED_END.items()}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split())
# Words of class and id that name boilerplate.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsors sponsored promo promos promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar widget widgets "
    "comment comments commentlist disqus respond replies reply share sharing social related recommended pagination pager "
    "paywall skip search form".split()
)
NEGATIONS = frozenset("has with no without".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _is_unseen(known: dict[str, str]) -> bool:
    return "hidden" in known or known.get("aria-hidden") == "true" or known.get("role") in ROLES or _HIDDEN.search(known.get("style", "")) is not None


def _is_named(known: dict[str, str]) -> bool:
    words = {w.lower() for w in _WORD.findall(f"{known.get('class', '')} {known.get('id', '')}")}
    return not words.isdisjoint(NAMES) and words.isdisjoint(NEGATIONS)


class Page(HTMLParser):
    """Collects the lines of a page and the elements they stand in; element 0 is the page itself."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.dropped, self.named = [""], [-1], [False], [False]
        self.open = [0]
        self.parts: list[str] = []
        self.passed = 0  # tags since the last line
        self.linked = 0  # characters of the line inside links
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, characters in links, element

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.lines.append((text, self.passed, self.linked, self._block()))
            self.passed = self.linked = 0

    def _block(self) -> int:
        return next((e for e in reversed(self.open) if self.tags[e] in BLOCK), 0)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.end_line()
        elif tag in CELL:
            self.parts.append(" ")
        self.passed += 1
        ends, stops = IMPLIED_END.get(tag, (None, None))
        if ends:
            self._pop(ends, stops, outermost=True)
        if tag in BLOCK:
            self._pop({"p"}, BLOCK - {"p"})
        if tag in VOID:
            return
        known = {k: v or "" for k, v in attrs}
        self.parents.append(self.open[-1])
        self.open.append(len(self.tags))
        self.tags.append("main" if known.get("role") == "main" and tag != "article" else tag)
        self.dropped.append(tag in SILENT or (bool(known) and _is_unseen(known)))
        self.named.append(bool(known) and tag not in ("html", "body", "main") and _is_named(known))

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers of the source are not needed

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not close an element of HTML

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.end_line()
        elif tag in CELL:
            self.parts.append(" ")
        self.passed += 1
        self._pop({tag}, {"table", "td", "th", "caption", "template"} - {tag} if tag in BLOCK or tag in CELL else BLOCK)

    def _pop(self, ends: set[str] | frozenset[str], stops: set[str] | frozenset[str], outermost: bool = False) -> None:
        """Close the innermost (or outermost) open element of ``ends`` inside the innermost of ``stops``."""
        found = None
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[place]]
            if tag in ends or (tag == "main" and "div" in ends):
                found = place
                if not outermost:
                    break
            elif tag in stops:
                break
        if found is not None:
            del self.open[found:]

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if any(self.tags[e] == "a" for e in self.open[-4:]):
            self.linked += len(data.strip())


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Ratios convolved with a Gaussian of three standard deviations to each side; the ends count as zero."""
    reach = max(1, int(3 * sigma + 0.5))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel / kernel.sum())[reach : reach + len(ratios)]


def extract(html: str | None) -> tuple[str, int]:
    """Main text of one page, blocks joined by an empty line, and the number of its blocks."""
    page = Page()
    for at in range(0, len(html or ""), FEED):
        page.feed(html[at : at + FEED])
    page.close()
    page.end_line()
    if not page.lines:
        return "", 0
    kept = _select(page)
    return "\n\n".join(page.lines[i][0] for i in kept), len(kept)


def _chain(page: Page, element: int) -> list[int]:
    out = []
    while element >= 0:
        out.append(element)
        element = page.parents[element]
    return out


def _select(page: Page) -> list[int]:
    chains: dict[int, list[int]] = {}
    for *_, element in page.lines:
        if element not in chains:
            chains[element] = _chain(page, element)
    open_to = _boilerplate(page, chains)
    readable = [not any(open_to[e] for e in chains[line[3]]) for line in page.lines]
    ratios = np.array([len(t) / max(1, tags) if ok and 2 * linked <= len(t) else 0.0 for (t, tags, linked, _), ok in zip(page.lines, readable, strict=True)])
    smoothed = smooth(ratios)
    threshold = LEVEL * smoothed.std()
    content = [i for i in np.flatnonzero((smoothed >= threshold) & (smoothed > 0)) if readable[i]]
    if not content:
        return []
    weight = dict.fromkeys(range(len(page.tags)), 0)
    for i in content:
        for e in chains[page.lines[i][3]]:
            weight[e] += len(page.lines[i][0])
    total = weight[0]
    whole = [e for e in weight if page.tags[e] in ("article", "main") and weight[e] >= ARTICLE_SHARE * total]
    articles = [e for e in whole if page.tags[e] == "article"]
    if whole:
        region = min(articles or whole)
        inner = {e for e in range(region + 1, len(page.tags)) if page.tags[e] == "article"}
        # Articles inside an article with text of its own are reactions to it.
        own = page.tags[region] == "article" and any(region in chains[page.lines[i][3]] and inner.isdisjoint(chains[page.lines[i][3]]) for i in content)
        return [
            i
            for i, line in enumerate(page.lines)
            if readable[i] and region in chains[line[3]] and not (own and not inner.isdisjoint(chains[line[3]]))
        ]
    region = max(e for e in weight if weight[e] >= OTHER_SHARE * total)
    # Without an article, a line that only its neighbours lift over the threshold must be of the kind of the others.
    strong = {i for i in content if ratios[i] >= threshold}
    blocks = {page.lines[i][3] for i in strong}
    parents, tags = {page.parents[b] for b in blocks}, {page.tags[b] for b in blocks}
    kinds = (tags | WRITTEN) if tags.isdisjoint(WRITTEN) else WRITTEN
    lifted = {i for i in content if page.tags[page.lines[i][3]] in kinds}
    return [
        i
        for i, (text, _, linked, block) in enumerate(page.lines)
        if readable[i]
        and region in chains[block]
        and (i in strong or i in lifted or (2 * linked <= len(text) and page.parents[block] in parents and page.tags[block] in kinds))
    ]


def _boilerplate(page: Page, chains: dict[int, list[int]]) -> list[bool]:
    """Elements to leave out: by tag, role or name, unless they hold the article itself."""
    holds, title, chars = set(), set(), [0] * len(page.tags)
    for element, tag in enumerate(page.tags):
        if tag in ("article", "main") and not (page.named[element] or page.dropped[element]):
            holds.update(_chain(page, element)[1:])
        elif tag == "h1":
            title.update(_chain(page, element)[1:])
    for text, *_, element in page.lines:
        for e in chains[element]:
            chars[e] += len(text)
    out = []
    for element, tag in enumerate(page.tags):
        wraps = element in holds or (element in title and 2 * chars[element] > chars[0])
        named = page.named[element] and not wraps
        dropped = page.dropped[element] and not (wraps and tag in ("nav", "menu", "aside", "form", "search"))
        inside = any(page.tags[e] in ("article", "main") for e in _chain(page, page.parents[element])) if tag == "header" else False
        out.append(named or dropped or (tag == "footer" and element not in holds) or (tag == "header" and not inside and element not in holds))
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html): page_id, url, text, n_chars and n_blocks.

    A null, empty or textless page has an empty text and no blocks. Rows are taken one
    by one, so repeated rows give repeated results and an empty table none. Pages
    are read whole, whatever their length; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for html in batch.column("html"):
                text, n = extract(html.as_py())
                texts.append(text)
                counts.append(n)
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars", "n_blocks"],
            )

    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return plain.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")
