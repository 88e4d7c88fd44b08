"""Main-text extraction by line-block distribution.

Markup is stripped to lines, one per block of the page. The weights of sliding windows of lines
surge where the main text begins and dive where it ends; what lies between the first surge and the last
dive is kept. A line weighs its characters that are no link text. Where a page marks its article, each line inside weighs
a surge more, and those outside nothing. Elements that never hold main text (scripts, forms, menus, notices, comments,
...) become empty lines.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Production parameters: lines in a window, the weight from which a window surges, the weight below which it dives.
WINDOW = 3
SURGE_CHARS = 86
DIVE_CHARS = 30

# HTML elements by how they are read, and words of class or id that mark boilerplate.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = RAW | frozenset("head nav aside form template noscript button select svg object canvas dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol
    optgroup option p pre section summary table tbody td tfoot th thead title tr ul""".split())
MAIN = frozenset(["article", "main"])
BOILERPLATE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar "
                              "navigation search".split())
BOILERPLATE_WORDS = frozenset("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment
    comments consent cookie cookies disqus footer form gdpr masthead menu modal nav navbar navigation newsletter
    notice notices pagination popup promo promoted promotion recommended related reply respond share sharing sidebar
    signup social sponsor sponsored subscribe subscription toolbar widget""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>|[^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _is_boilerplate(attributes: str) -> str:
    """Why an element is boilerplate: "word" for its class or id, "mark" for what says so by itself, or empty."""
    found = ""
    for match in _ATTRIBUTE.finditer(attributes.rstrip(">")):
        name, value = match[1].lower(), html.unescape(match[2] or match[3] or match[4] or "").lower()
        if name in ("class", "id") and not BOILERPLATE_WORDS.isdisjoint(re.split(r"[^a-z]+", value)):
            found = "word"
        if name == "hidden" or name == "aria-hidden" and value == "true" or \
                name == "role" and value in BOILERPLATE_ROLES or name == "style" and _HIDDEN.search(value):
            return "mark"
    return found


class _Lines:
    """Reads a page into lines: [text, is inside the article, characters of link text]; a dropped element leaves empty lines."""

    def __init__(self, page: str, spared: frozenset[int] = frozenset()):
        self.lines: list[tuple[str, bool, int]] = []
        self.has_main = False
        self._text: list[str] = []
        self._open: list[tuple[str, bool, int, int, int]] = []  # name, dropped, number if for a word only, counts before it
        self._dropped = self._hard = self._main = self._links = self._linked = 0
        self._spared, self._marked = spared, 0
        self.chars = self.articles = 0  # outside of elements that are dropped whatever they hold
        self.held: dict[int, tuple[int, int]] = {}  # articles and characters in each element dropped for a word
        self._read(page)

    def _end_line(self) -> None:
        if self._text:
            if text := " ".join(html.unescape("".join(self._text)).split()):
                self.lines.append((text, self._main > 0, min(self._linked, len(text))))
            self._text.clear()
            self._linked = 0

    def _add(self, text: str) -> None:
        if not self._dropped:
            self._text.append(text)
            if self._links:
                self._linked += len(" ".join(html.unescape(text).split()))

    def _pop(self, to: int) -> None:
        while len(self._open) > to:
            name, dropped, number, chars, articles = self._open.pop()
            self._dropped -= dropped
            self._hard -= dropped and not number
            if number:
                self.held[number] = self.articles - articles, self.chars - chars
            self._main -= name in MAIN
            self._links -= name == "a"
            if dropped and not self._dropped:
                self.lines.extend([("", False, 0)] * WINDOW)

    def _close(self, name: str) -> None:
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == name:
                self._pop(i)
                return

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK and any(x[0] == "p" for x in self._open[-8:]):
            self._close("p")  # a block ends an open paragraph
        if name in ("li", "tr", "td", "th", "dt", "dd", "option") and self._open and self._open[-1][0] == name:
            self._pop(len(self._open) - 1)
        if name == "a":
            self._close("a")  # links don't nest
        if name in VOID or attributes.endswith("/>"):
            return
        dropped = name in DROPPED or name in ("header", "footer") and (name == "footer" or not self._main)
        number = 0
        if not dropped and name not in ("html", "body", *MAIN) and (why := _is_boilerplate(attributes)):
            number = self._marked = self._marked + (why == "word")
            number *= why == "word"
            dropped = not number or number not in self._spared
        self._open.append((name, dropped, number if dropped else 0, self.chars, self.articles))
        self._dropped += dropped
        self._links += name == "a"
        self._hard += dropped and not self._open[-1][2]
        if name in MAIN:
            self._main += 1
            self.has_main |= not self._dropped
            self.articles += not self._hard

    def _count(self, text: str) -> None:
        if not self._hard:
            self.chars += len(text.strip())

    def _read(self, page: str) -> None:
        at = 0
        while match := _TAG.search(page, at):
            if match.start() > at:
                self._count(page[at:match.start()])
                self._add(page[at:match.start()])
            at, name = match.end(), (match[2] or "").lower()
            if not name:
                continue
            if name in BLOCK:
                self._end_line()
            if match[1]:
                self._close(name)
            else:
                self._start(name, match[3])
                if name in RAW and self._open and self._open[-1][0] == name:
                    end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = end.end() if end else len(page)
                    self._close(name)
        self._count(page[at:])
        self._add(page[at:])
        self._end_line()
        self._pop(0)


def _read(page: str) -> _Lines:
    """The page's lines. No class or id word drops the page's only articles, or most of a page without one."""
    spared: frozenset[int] = frozenset()
    while True:
        read = _Lines(page, spared)
        if read.has_main:
            return read
        if read.articles:  # the outermost that holds some, and those in it that hold as many
            most = read.held[min(x for x, (n, _) in read.held.items() if n)][0]
            held = [x for x, (n, _) in read.held.items() if n == most]
        else:
            held = [x for x, (_, n) in read.held.items() if 2 * n > read.chars]
        if not held:
            return read
        spared |= frozenset(held)


def line_weights(lines: list[tuple[str, bool, int]], has_main: bool, surge_chars: int = SURGE_CHARS) -> list[int]:
    """What each line weighs: its characters less those of links, in a marked article a surge more, outside of it nothing.

    On a page whose text is all links, these weigh as other text.
    """
    if has_main:
        return [len(text) - linked + surge_chars if inside and text else 0 for text, inside, linked in lines]
    plain = [len(text) - linked for text, _, linked in lines]
    return plain if any(plain) else [len(text) for text, _, _ in lines]


def main_text(page: str | None, window: int = WINDOW, surge_chars: int = SURGE_CHARS, dive_chars: int = DIVE_CHARS) -> str:
    """The lines between surge and dive points, joined by spaces; empty for null or empty pages.

    A window surges from ``surge_chars`` on (or half the heaviest window, if that is less), and dives below ``dive_chars``
    (or a quarter of it).
    """
    if not page:
        return ""
    read = _read(page)
    weights = line_weights(read.lines, read.has_main, surge_chars)
    sums = [sum(weights[i:i + window]) for i in range(len(weights))]
    most = max(sums, default=0)
    surge, dive = min(surge_chars, max(1, most // 2)), min(dive_chars, max(1, most // 4))
    first, end, i = len(sums), 0, 0
    while i < len(sums):
        if not weights[i] or sums[i] < surge:
            i += 1
            continue
        first = min(first, i)
        while i < len(sums) and sums[i] >= dive:
            i += 1
        end = i
    # A dropped element within the text parts no paragraph from it; where an article is marked, other lines go.
    return " ".join(text for text, inside, _ in read.lines[first:end] if text and (inside or not read.has_main))


def extract(page: Column) -> Column:
    """String column: the main text of the HTML in ``page``, whole; empty if there is none."""
    @F.pandas_udf(T.StringType())
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text).astype(object)

    return text(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    A null, empty or textless page has text '' and n_chars 0. Rows are independent: repeated rows and
    null ids or urls are carried through; other columns are not read.
    """
    texts = pages.select("page_id", "url", extract(F.coalesce("html", F.lit(""))).alias("text"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
