"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped into lines, one for each block element, with the length of the text of each. The sums of lengths over
``SPAN`` lines surge where the article begins and dive where it ends. Lines of elements that are never article (menus,
scripts, hidden ones, and the like) have no length, and neither have lines that are mostly links. Forms and elements that words
of their class, id or role mark are doubtful: they may be advertisements or comments, or the layout around the article. They
are judged by the text that surges in them (``discarded``), and then those that are not article are left out too. The text between the surge and dive points names the element that holds the article: the outermost
article or main around most of it, else the innermost element around all of it. Every line of that element is kept,
however short, but those of elements that are never article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common

#: Lines that a block sums over, and the least sum that is a surge (less on pages whose largest sum is below twice that).
SPAN = 3
SURGE = 86
#: Least shares of the page's surging text: of a doubtful element to be kept, and of an article or main to count for that.
MOST = 0.5
SOME = 0.2

# Fixed names of HTML, with those that are never article text, and words that make an element doubtful.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("aside button dialog fieldset footer head header menu nav select".split())
DOUBTFUL_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus discussion footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification pagination pager popup promo promoted promotion recommended related reply replies "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget "
    "widgets".split()
)
#: Elements that no mark makes doubtful.
WHOLE = frozenset("html body article main".split())
_RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|textarea|title|iframe|object|canvas|math)\b[^>]*>.*?(?:</\1\s*>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
# A quoted value ends at its quote; values with a "<" are read by the second form, so that no quote is searched twice.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+)>|<[/!?a-zA-Z][^>]*+>?""")
_NAME = re.compile(r"[/!?]?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _words(attributes: str) -> list[str]:
    return _WORD.findall(" ".join(a or b or c for a, b, c in _MARKS.findall(attributes)))


def never(tag: str, attributes: str) -> bool:
    """Whether an element is never article text."""
    if tag in NEVER:
        return True
    if tag == "article":
        return any(w.lower() in ("comment", "comments", "reply") for w in _words(attributes))
    return tag not in WHOLE and _HIDDEN.search(attributes) is not None


def doubtful(tag: str, attributes: str) -> bool:
    """Whether an element may be no article text, by its tag or marks."""
    return tag == "form" or "=" in attributes and tag not in WHOLE and any(w.lower() in DOUBTFUL_WORDS for w in _words(attributes))


class Lines:
    """The lines of a page: text, linked characters, and the open block elements around each, as a path of numbers."""

    def __init__(self, page: str):
        self.rows: list[tuple[str, int, tuple[int, ...]]] = []
        self.tags: dict[int, str] = {}
        #: The element around each, and whether a link was open before each doubtful one.
        self.parents: dict[int, int] = {}
        self.doubtful: dict[int, int] = {}
        self._inline: dict[str, int] = {}
        self._open: list[tuple[str, int]] = []
        self._parts: list[str] = []
        self._linked = self._links = 0
        self._skip: tuple[str, int] | None = None
        at = 0
        page = _RAW.sub(" ", page)
        for m in _TAG.finditer(page):
            if m.start() > at:
                self._text(page[at : m.start()])
            at = m.end()
            name, closing, attributes = m.group(2), m.group(1), m.group(3) or ""
            if name is None:
                found = _NAME.match(m.group(), 1)
                if not found:
                    continue
                name, closing = found.group(1), "/" if m.group()[1] == "/" else ""
            self._tag(name.lower(), bool(closing), attributes)
        if at < len(page):
            self._text(page[at:])
        self._end_line()

    def _text(self, text: str) -> None:
        if self._skip is None:
            self._parts.append(text)
            if self._links:
                self._linked += len(text.strip())

    def _end_line(self) -> None:
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            if text:
                self.rows.append((text, self._linked, tuple(n for _, n in self._open)))
            self._parts = []
        self._linked = 0

    def _tag(self, tag: str, closing: bool, attributes: str) -> None:
        if self._skip is not None:
            name, depth = self._skip
            if tag == name:
                self._skip = (name, depth - 1 if closing else depth + 1) if depth > 1 or not closing else None
                return
            over = tag == "body" if name == "head" else name in ("p", "li") and tag in BLOCKS and not closing
            if not over:
                return
            self._skip = None
        if tag == "br":
            self._parts.append(" ")
        elif not closing and tag not in VOID and never(tag, attributes):
            self._end_line()
            self._skip = (tag, 1)
        elif not closing and tag not in VOID and doubtful(tag, attributes):
            self._end_line()
            self._open_element(tag)
            self.doubtful[len(self.tags) - 1] = self._links
            if tag not in BLOCKS:
                self._inline[tag] = self._inline.get(tag, 0) + 1
            if tag == "a":
                self._links = 1
        elif tag in BLOCKS or self._inline.get(tag):
            if tag in BLOCKS:
                self._end_line()
            if closing:
                if any(t == tag for t, _ in self._open):
                    self._close_elements(next(i for i in reversed(range(len(self._open))) if self._open[i][0] == tag))
            elif tag not in VOID:
                self._open_element(tag)
                if tag not in BLOCKS:
                    self._inline[tag] += 1
        elif tag == "a":
            self._links = 0 if closing else 1

    def _open_element(self, tag: str) -> None:
        if tag in BLOCKS:
            i = len(self._open) - 1
            while i >= 0 and self._open[i][0] not in BLOCKS:
                i -= 1
            if i >= 0 and self._open[i][0] == "p":  # a paragraph ends where the next block begins
                self._close_elements(i)
            elif tag == "li":  # and a doubtful item where the next one does
                i = next((i for i in reversed(range(len(self._open))) if self._open[i][0] in ("li", "ul", "ol", "menu")), -1)
                if i >= 0 and self._open[i][0] == "li" and self._open[i][1] in self.doubtful:
                    self._close_elements(i)
        number = len(self.tags)
        self.tags[number] = tag
        self.parents[number] = self._open[-1][1] if self._open else -1
        self._open.append((tag, number))

    def _close_elements(self, first: int) -> None:
        """Close the open elements from ``first`` on, and with a doubtful one its line and its links."""
        if any(n in self.doubtful for _, n in self._open[first:]):
            self._end_line()
        while len(self._open) > first:
            tag, number = self._open.pop()
            self._links = self.doubtful.get(number, self._links)
            if tag not in BLOCKS:
                self._inline[tag] -= 1


def regions(lengths: list[int]) -> list[int]:
    """Lines between surge and dive points of the block sums."""
    sums = [sum(lengths[i : i + SPAN]) for i in range(len(lengths))]
    surge = min(SURGE, max(sums, default=0) / 2)
    kept, inside = [], False
    for i, total in enumerate(sums):
        if not inside and total > surge and lengths[i]:
            inside = True
        elif inside and total == 0:
            inside = False
        if inside and lengths[i]:
            kept.append(i)
    return kept


def _lengths(rows: list[tuple[str, int, tuple[int, ...]]]) -> list[int]:
    return [0 if 2 * linked > len(text) else len(text) for text, linked, _ in rows]


def discarded(lines: Lines) -> set[int]:
    """Doubtful elements that are no article text, judged by the share of the page's surging text in them.

    One that holds an article or main with SOME of it is kept. Of the others, one beside such an article or main is discarded (as
    long comments are), else one with less than MOST. If too little is left (the article lies in several doubtful
    elements), those with less are kept too, at last all with surging text.
    """
    if not lines.doubtful:
        return set()
    lengths = _lengths(lines.rows)
    found = regions(lengths)
    most: dict[int, int] = {}
    for i in found:
        for number in lines.rows[i][2]:
            most[number] = most.get(number, 0) + lengths[i]
    total = sum(lengths[i] for i in found)
    anchors = {n for n in most if lines.tags[n] in ("article", "main") and most[n] >= SOME * total}
    holding: set[int] = set()
    for n in anchors:
        while (n := lines.parents[n]) >= 0 and n not in holding:
            holding.add(n)
    within = {-1: 0}  # articles and mains around each element, or itself one; numbers rise inwards
    for n, parent in lines.parents.items():
        within[n] = within[parent] + (n in anchors)
    judged = [n for n in lines.doubtful if n not in holding]
    out: set[int] = set()
    for least in (MOST, SOME, 0.0):
        beside = least == MOST
        out = {
            n
            for n in judged
            if not most.get(n) or most[n] < least * total or beside and within[n] < len(anchors)
        }
        left = sum(lengths[i] for i in found if out.isdisjoint(lines.rows[i][2]))
        if left >= SOME * total:
            break
    return out


def main_text(page: str | None) -> str:
    """Blocks of the article in page order, one to a line; empty for a null page or one without text."""
    lines = Lines(page or "")
    out = discarded(lines)
    rows = [row for row in lines.rows if out.isdisjoint(row[2])]
    lengths = _lengths(rows)
    found = regions(lengths)
    if not found:
        return ""
    most: dict[int, int] = {}
    for i in found:
        for number in rows[i][2]:
            most[number] = most.get(number, 0) + lengths[i]
    total = sum(lengths[i] for i in found)
    # numbers rise inwards: the outermost article or main with most of the text, else the innermost element with all of it
    holders = [n for n in sorted(most) if lines.tags[n] in ("article", "main") and 2 * most[n] > total]
    holder = next((n for n in holders if lines.tags[n] == "article"), holders[0] if holders else None)
    if holder is None:
        holder = max((n for n in most if most[n] == total), default=None)
        if holder is None or lines.tags[holder] in ("body", "html"):
            first, last = found[0], found[-1]
            return "\n".join(text for i, (text, _, _) in enumerate(rows) if first <= i <= last and lengths[i])
    return "\n".join(text for text, _, path in rows if holder in path)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null, empty or textless page has an empty text. Repeated rows repeat, null keys and urls stay. Other columns are ignored.
    """
    pages = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(page).cast("string").alias("html"))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return common.in_batches(pages, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
