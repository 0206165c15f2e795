"""Main text of web pages by the distribution of text over line blocks.

A page is stripped to lines, one for each block of text. The text lengths of `window` lines in a row are summed; the main
text runs from the line where the sums surge to the one where they dive to nothing, in the region that has most. Tags,
roles, classes and ids only weigh lines: text of menus, asides, adverts, notices, reader comments and the like has no length,
a line of links has little, and beside an article's text nothing else has any. Classes and ids aren't trusted where they
would leave no text to speak of.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.workspace import small_batches

#: Elements whose text is never part of a page.
RAW = "script|style|noscript|template|svg|title|iframe|object|textarea|select|canvas|audio|video|annotation-xml|annotation"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|</?\Z",
    re.S | re.I,
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Inline as well; their pieces are parted by spaces.
MATH = frozenset(
    "math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
INLINE |= MATH
MAIN = frozenset(("article", "main"))
APART = frozenset("nav footer aside form menu dialog button fieldset head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
#: Elements whose end tags can't be left out; only these nest here. All other blocks just end a line.
NESTING = MAIN | APART | frozenset("html body header div section table ul ol dl figure blockquote details center address pre".split())
#: What may stand in a head; any other element ends it.
HEADINGS = frozenset("meta link base title script style noscript template".split())
ROLE = re.compile(r"\brole\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
MARK = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Names (of classes and ids) of what is no part of an article; PARTS count as the last part of a name too (site-footer),
#: STARTS as the first (comment-body). Names with a part of LAYOUT say how a page is laid out, not what an element is.
STARTS = frozenset("comment comments ad ads advert adverts advertisement cookie cookies sponsored".split())
PARTS = STARTS | frozenset("sidebar sidebars nav navbar navigation menu menus footer breadcrumb breadcrumbs newsletter banner".split())
NAMES = PARTS | frozenset("commentlist respond disqus notice notices alert alerts advertising sponsor promo consent gdpr popup modal subscribe".split())
HEADERS = frozenset("header site-header masthead topbar top-bar".split())
LAYOUT = frozenset("no not has with without open closed enabled disabled hide hidden show".split())
#: An article is left out for these alone.
NO_ARTICLE = frozenset("comment comments ad advert advertisement sponsored".split())

Line = tuple[str, float, int]


def _marked(rest: str, article: bool, own: bool) -> bool:
    """Whether a tag's classes or id name what is no part of an article; own: of an article or main element."""
    for found in MARK.finditer(rest):
        for name in (found[1] or found[2] or found[3] or "").lower().split():
            parts = name.replace("_", "-").split("-")
            if own:
                if name in NO_ARTICLE:
                    return True
            elif LAYOUT.isdisjoint(parts) and (name in NAMES or parts[-1] in PARTS or parts[0] in STARTS or not article and name in HEADERS):
                return True
    return False


class _Lines:
    """lines of (text, length, gap): gap 0 is a line of text, 1 stands for an element's edge, 2 for that of an outermost
    article; whether text stands in an article, and whether a class or id left anything out."""

    def __init__(self, page: str, weighed: bool = True, marked: bool = True) -> None:
        found, self.marks = _read(page, weighed, marked)
        self.article = any(inside and text for text, _, _, inside in found)
        self.lines: list[Line] = [(text, 0 if self.article and not inside else length, gap) for text, length, gap, inside in found]


def _read(page: str, weighed: bool, marked: bool) -> tuple[list[tuple[str, float, int, bool]], bool]:
    """Lines with whether they stand in an article; and whether a class or id left anything out.

    `weighed` leaves out the text of menus, asides and the like, `marked` that of elements whose class or id says that they
    are. Each tag is looked at once: a count of open elements by name tells whether an end tag ends any, and what it pops was
    pushed once.
    """
    lines: list[tuple[str, float, int, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, left out, is an article
    opened: Counter[str] = Counter()
    links = out = article = anchor = 0  # anchor: the depth below which an open link stands, plus one
    told = skip = marks = False  # an article's text was there; this line's own element is left out; any was

    def flush() -> None:
        nonlocal links, told, skip
        skip = False
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                share = 0 if article else min(1.0, links / len(text))
                foot = not article and text.startswith("\u00a9")
                lines.append((text, 0 if foot or share >= 0.5 else len(text) * (1 - share), 0, article > 0))
                told |= article > 0
            held.clear()
            links = 0

    def gap(kind: int) -> None:
        flush()
        lines.append(("", 0, kind, article > 0))

    def pop() -> None:
        nonlocal out, article, anchor
        flush()
        name, left_out, own = stack.pop()
        opened[name] -= 1
        out -= left_out
        anchor = min(anchor, len(stack) + 1)
        article -= own
        if not article:
            gap(2 if own else 1)

    def text(piece: str) -> None:
        nonlocal links
        if piece and not out and not skip:
            held.append(piece)
            if anchor:
                links += len(piece)

    at = 0
    for m in TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            if m[1]:
                held.append(" ")
            continue
        ends = bool(m[2] or m[5])
        if name == "br" or name in MATH:
            held.append(" ")
        elif name == "a":
            anchor = 0 if ends else len(stack) + 1
        if name in INLINE:
            continue
        flush()
        if ends:
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        rest = m[4] if m[4] is not None else m[7] or ""
        if stack and stack[-1][0] == "head" and name not in HEADINGS:
            pop()
        if name not in NESTING or rest.endswith("/"):
            if marked and "=" in rest and not rest.endswith("/") and _marked(rest, article > 0, False):
                skip = marks = True
            continue
        found = ROLE.search(rest) if "=" in rest else None
        roles = frozenset((found[1] or found[2] or found[3] or "").lower().split()) if found else frozenset()
        own = name in MAIN or bool(roles & {"main", "article"})
        mark = marked and "=" in rest and name not in ("html", "body") and _marked(rest, article > 0, own)
        marks, own = marks or mark, own and not mark
        if own and out and not article and not told:
            while stack and out:  # a menu or the like was never closed, or holds the whole page
                pop()
        apart = name in APART or name == "header" and not article or bool(roles & ROLES)
        left_out, own = mark or weighed and apart and not own or name == "head", own and not out
        if not article:
            gap(2 if own else 1)
        stack.append((name, left_out, own))
        opened[name] += 1
        out += left_out
        article += own
    text(page[at:])
    flush()
    while stack:
        pop()
    return lines, marks


def _region(lines: list[Line], window: int, surge: float) -> tuple[str, float]:
    """The text from surge to dive in the region of lines that has most length, and that length."""
    kept: list[str] = []
    lengths: list[float] = []
    blank = 0
    for text, length, kind in lines:
        if kind == 0:
            kept.append(text)
            lengths.append(length)
            blank = 0
            continue
        n = window - blank if kind == 2 else 1 if blank < window - 1 else 0  # edges part lines, only those of articles part regions
        kept += [""] * n
        lengths += [0.0] * n
        blank += n
    total = np.cumsum(np.concatenate(([0.0], lengths, [0.0] * window)))
    sums = total[window:] - total[:-window]
    filled = np.concatenate(([False], sums[: len(lengths)] > 0, [False]))
    starts, ends = np.flatnonzero(filled[1:] & ~filled[:-1]), np.flatnonzero(filled[:-1] & ~filled[1:])
    if not len(starts):
        return "", 0.0
    mass = total[ends] - total[starts]
    best = int(mass.argmax())
    low, high = int(starts[best]), int(ends[best])
    over = np.flatnonzero(sums[low:high] > surge)
    low += int(over[0]) if len(over) else 0
    while low < high and not lengths[low]:
        low += 1
    while high > low and not lengths[high - 1]:
        high -= 1
    return "\n".join(x for x in kept[low:high] if x), float(mass[best])


def main_text(page: str | None, window: int = 3, surge: float = 86) -> str:
    """The main text of one page: blocks in page order, joined by line ends; empty for null, empty and text-free pages.

    Inside a block white space becomes one space. A line's length is that of its text, times the share that is no link
    (none, if half or more is). Where an article or main element has text, lines outside have no length. Elements' edges are
    empty lines, `window` of them around outermost articles. Regions of lines are parted where sums over `window` lines in a
    row are zero; of the one with most length the text starts where a sum exceeds `surge` (at its start if none does) and goes
    on until the sums fall to zero. So of several outermost articles the one with most text is taken, from its first line on,
    whole but for adverts, notices, comments and the like in it. Classes and ids don't count where, without an article, they leave less than `surge`
    of length, nor tags and roles where they leave none. Work grows with the page's length, however badly it is nested.
    """
    if not page:
        return ""
    read = _Lines(page)
    got, mass = _region(read.lines, window, 0 if read.article else surge)
    if read.marks and not read.article and mass < surge:
        got, mass = _region(_Lines(page, marked=False).lines, window, surge)
    return got if mass else _region(_Lines(page, weighed=False, marked=False).lines, window, surge)[0]


def extract_main_text(pages: DataFrame, html_col: str = "html", to: str = "text") -> DataFrame:
    """pages with the main text of each in column `to` (which replaces one of that name). See main_text().

    Null html gives an empty text; rows are independent, so repeated rows give repeated results and an empty table none.
    """

    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def texts(batch: pd.Series) -> pd.Series:
        return batch.map(main_text)

    return pages.withColumn(to, texts(F.col(html_col)))


def n_chars(text: Column) -> Column:
    return F.length(text).cast("long")
