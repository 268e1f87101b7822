"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskflow.llm.words import with_columns

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NEVER_CONTENT = frozenset(
    "aside button canvas dialog footer form head iframe input label map math menu nav noscript object option script "
    "select style svg template textarea title".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
# Words of class and id names that mark what is not the article.
MARKS = frozenset(
    "ad ads adbox adsense banner breadcrumb breadcrumbs consent cookie cookies disclaimer disqus footer gdpr login menu "
    "modal nav navbar navigation newsletter notice notification overlay pager pagination popup promo promoted "
    "promotion recommended related replies reply respond sharing share sidebar signup skyscraper social sponsor "
    "sponsored subscribe subscription tagcloud toolbar widget widgets".split()
)
MARK_STARTS = ("advert", "comment", "sidebar", "sponsor", "cookie", "newsletter")
READERS = frozenset("comment comments disqus replies reply respond".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS_ITEMS = ("ul", "ol", "dl", "table", "tbody", "thead", "div", "article", "body")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_ARTICLE = frozenset("ul ol li dl dt dd blockquote pre figure figcaption table thead tbody tr td th caption".split())
_NAME = re.compile(r"[a-z]+")
_UNENDED = re.compile(r"<[A-Za-z/!?]")


class Line(NamedTuple):
    text: str
    chars: int  # without white space
    plain: int  # of these, outside links
    tags: int
    box: int  # number of the element that holds the line's block
    main: int  # number of the article or main element around it, or 0
    mark: int  # place of the innermost marked element around it, or 0
    kind: str  # "heading", "p" or ""
    skip: bool

    @property
    def links(self) -> bool:
        """Whether an entry of a menu: mostly links, and no paragraph or heading."""
        return not self.kind and 2 * self.plain < self.chars


class Open(NamedTuple):
    tag: str
    block: int  # place of the innermost block element on the stack, itself included, or -1
    p: int  # place of a paragraph that only inline elements separate from here, or -1
    box: int
    main: int
    mark: int
    kind: str
    skip: bool


class Mark(NamedTuple):
    """An element whose class or id names extras."""

    over: int  # place of the mark around it, or 0
    comment: bool  # of readers
    main: bool  # inside an article or main element


class Lines(HTMLParser):
    """Turns a page into lines: the texts between starts and ends of block elements.

    Every step looks at the top of the stack and at the places of open elements by tag, never through the stack, so a
    page takes time in proportion to its length however deep it nests.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[Open] = []
        self.places: dict[str, list[int]] = {}
        self.marks = [Mark(0, False, False)]
        self.made, self.tags, self.parts, self.chars, self.plain = 0, 0, [], 0, 0

    def flush(self) -> None:
        if self.chars:
            top = self.top()
            text = " ".join("".join(self.parts).split())
            self.lines.append(Line(text, self.chars, self.plain, max(1, self.tags), top.box, top.main, top.mark, top.kind, top.skip))
            self.tags = 0
        self.parts, self.chars, self.plain = [], 0, 0

    def top(self) -> Open:
        return self.stack[-1] if self.stack else Open("", -1, -1, 0, 0, 0, "", False)

    def place(self, *tags: str) -> int:
        """Place of the innermost open element with one of ``tags``, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        inline = tag in INLINE
        if not inline:
            self.flush()
            if tag == "body":
                self.cut(0)
            else:
                self.close_open(tag)
        elif tag in ("br", "img", "wbr"):
            self.parts.append("" if tag == "wbr" else " ")
        if tag in VOID:
            return
        over, at = self.top(), len(self.stack)
        self.made += 1
        main, mark, skip = over.main, over.mark, over.skip
        if not skip and tag not in ("html", "body"):
            skip = tag in NEVER_CONTENT or tag == "header" and not main or any(n == "hidden" or n == "role" and (v or "").lower() in ROLES for n, v in attrs)
            found = self.marked(attrs, main) if attrs else ""
            if found == "comment" or found and tag not in ("article", "main"):
                self.marks.append(Mark(mark, found == "comment", bool(main)))
                mark = len(self.marks) - 1
        if tag in ("article", "main") and not skip:
            main = main or self.made
        kind = over.kind if inline else "heading" if tag in HEADINGS else "p" if tag == "p" else ""
        part = inline or kind or main and tag in IN_ARTICLE
        box = over.box if part else self.made
        self.places.setdefault(tag, []).append(at)
        self.stack.append(Open(tag, over.block if inline else at, at if tag == "p" else over.p if inline else -1, box, main, mark, kind, skip))

    def close_open(self, tag: str) -> None:
        """Elements whose end tag may be left out end where the next one starts."""
        if self.top().p >= 0:
            self.cut(self.top().p)
        if tag in CLOSED_BY:
            at = self.place(*CLOSED_BY[tag])
            if at >= 0 and at > self.place(*HOLDS_ITEMS):
                self.cut(at)

    @staticmethod
    def marked(attrs, main: int) -> str:
        """Whether the names of an element's class and id speak of readers' comments ("comment") or of other extras ("extra")."""
        names = [w for name, value in attrs if name in ("class", "id") for w in _NAME.findall((value or "").lower())]
        if not READERS.isdisjoint(names):
            return "comment"
        return "extra" if any(w in MARKS or w.startswith(MARK_STARTS) or w == "header" and not main for w in names) else ""

    def handle_endtag(self, tag):
        self.tags += 1
        inline = tag in INLINE
        if not inline:
            self.flush()
        at = self.place(tag)
        if at >= 0 and not (inline and at < self.top().block):  # an inline element does not end a block
            self.cut(at)

    def handle_data(self, data):
        self.parts.append(data)
        chars = sum(map(len, data.split()))
        self.chars += chars
        if not self.places.get("a"):
            self.plain += chars

    def read(self, page: str) -> list[Line]:
        """Lines of a whole page; a tag that is never ended hides what follows, as in a browser, and so does a comment."""
        end = page.rfind(">") + 1
        unended = _UNENDED.search(page, end)
        self.feed(page[: unended.start()] if unended else page)
        if self.rawdata.startswith("<!--"):
            self.rawdata = ""
        self.close()
        self.flush()
        return self.lines


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """Values convolved with a Gaussian of ``sigma`` lines, its weights scaled to one at the borders too."""
    reach = max(1, int(np.ceil(3 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    middle = slice(reach, reach + len(values))
    return np.convolve(values, weights)[middle] / np.convolve(np.ones(len(values)), weights)[middle]


def dropped_marks(lines: list[Line], marks: list[Mark]) -> list[bool]:
    """For each mark, whether its lines are no content.

    The names are weighed against the text: a marked element that holds at least half of the page's text outside links
    is the article whatever its class says, unless the class speaks of readers' comments, or the element lies outside
    the article or main elements of a page that has text in these.
    """
    mass, total = [0] * len(marks), 0
    for x in lines:
        if not x.skip:
            mass[x.mark] += x.plain
            total += x.plain
    for i in range(len(marks) - 1, 0, -1):
        mass[marks[i].over] += mass[i]
    rooted = any(x.main and x.plain and not x.skip and not marks[x.mark].comment for x in lines)
    dropped = [False] * len(marks)
    for i in range(1, len(marks)):
        m = marks[i]
        dropped[i] = dropped[m.over] or m.comment or rooted and not m.main or 2 * mass[i] < total
    return dropped


def regions(ratio: np.ndarray, sigma: float, share: float) -> list[tuple[int, int]]:
    """Runs [start, end) of lines whose smoothed ratio is at least ``share`` standard deviations.

    Smoothing lends short lines the ratio of their neighbours, which joins a run but must not lengthen it: its first
    and last line reach the threshold by themselves.
    """
    level = smoothed(ratio, sigma)
    least = min(share * level.std(), level.max())
    inside = np.concatenate([[False], level >= least, [False]])
    own = (ratio >= least) & (ratio > 0)
    found = []
    for a, b in zip(np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:]), strict=True):
        at = np.flatnonzero(own[a:b])
        if len(at):
            found.append((int(a + at[0]), int(a + at[-1]) + 1))
    if not found and ratio.any():
        best = int(ratio.argmax())
        found = [(best, best + 1)]
    return found


def main_text(html: str, sigma: float = 1.0, share: float = 1.0, least: float = 0.2) -> str:
    """The page's article: blocks in page order, joined by an empty line.

    Each line's ratio is its characters outside links by its tags, links being tags too; menu entries, lines inside
    footers, forms and the like, and lines of marked elements that do not hold the bulk of the text count as 0. Runs of
    high smoothed ratio are the content regions. If at least half of their text lies in article or main elements, only
    those count; otherwise only regions with ``least`` of the largest one's text or in its element. The text runs from
    the first to the last region (in each article) and includes the other blocks of the elements that hold a region,
    and headings right before any of these. Lines counted as 0 are never part of it.
    """
    parser = Lines()
    lines = parser.read(html)
    dropped = dropped_marks(lines, parser.marks)
    dead = [x.skip or dropped[x.mark] or x.links for x in lines]
    found = regions(np.array([0.0 if d else x.plain / x.tags for x, d in zip(lines, dead, strict=True)]), sigma, share) if lines else []
    if not found:
        return ""
    mass = [sum(x.plain for x, d in zip(lines[a:b], dead[a:b], strict=True) if not d) for a, b in found]
    rooted = sum(x.plain for a, b in found for x, d in zip(lines[a:b], dead[a:b], strict=True) if x.main and not d)
    in_roots = 2 * rooted >= sum(mass)
    if in_roots:
        at = [i for a, b in found for i in range(a, b) if lines[i].main and not dead[i]]
    else:
        a, b = found[int(np.argmax(mass))]
        boxes = {x.box for x in lines[a:b]}
        large = [(a, b) for (a, b), m in zip(found, mass, strict=True) if m >= least * max(mass) or any(x.box in boxes for x in lines[a:b])]
        at = [i for a, b in large for i in range(a, b) if not dead[i]]
    spans: dict[int, tuple[int, int]] = {}
    for i in at:
        root = lines[i].main if in_roots else 0
        spans[root] = (spans.get(root, (i, i))[0], i)
    boxes = {lines[i].box for i in at}
    kept, after = [False] * len(lines), False
    for i in range(len(lines) - 1, -1, -1):
        x = lines[i]
        if dead[i] or in_roots and x.main not in spans:
            continue
        first, last = spans.get(x.main if in_roots else 0, (0, -1))
        kept[i] = after = first <= i <= last or x.box in boxes or x.kind == "heading" and after
    return "\n\n".join(x.text for x, k in zip(lines, kept, strict=True) if k)


def extract(pages: DataFrame, html: str = "html", text: str = "text", sigma: float = 1.0, share: float = 1.0) -> DataFrame:
    """``pages`` with the main text of each page in column ``text``; a map over rows without any shuffle.

    Null, empty and markup-only pages give an empty text, broken markup is read as far as it makes sense, a page of
    any length is read whole, and repeated pages are each extracted. Other columns are kept.
    """
    new = T.StructType([T.StructField(text, T.StringType())])

    def start():
        return lambda texts: [pa.array([main_text(t.decode("utf-8", "replace"), sigma, share) for t in texts], pa.string())]

    return with_columns(pages, html, new, start)
