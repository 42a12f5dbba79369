"""Main text of web pages by the distribution of text over lines.

Markup is stripped to one line per block. Menus, headers, footers, sidebars, notices, adverts, forms and reader comments count as
empty lines: elements of such a kind, and elements whose class or id names one. A name is a weak mark. It says nothing on ``html``
and ``body``, around the only article, behind a word such as "no" or "with", or if the page has no surge without the text it covers.

The lengths of the lines are summed over a sliding window. Text surges where the sum reaches SURGE and a share of the page's own largest
sum, and dives where it falls below a far smaller share; what lies between is kept, and short lines at its borders that are no
sentence are not: they belong to the menu or the footer next to it. A marked article is the text itself and is kept whole; text beside
it only if it is longer than the article.

Defined cases: a null or empty page has an empty text; repeated rows give the same text each; markup that is never closed ends with
the element around it; among equal sums the first one counts; an empty table gives an empty result. Very long pages and ends of elements
that were never opened take linear time. Other columns are carried.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewgrove.llm.batches import alongside

WINDOW = 3
# Least window sum at a surge, or the largest one of a page if that is less; and the share of the largest one that a surge needs.
SURGE = 80
SURGE_SHARE = 0.15
# A dive is where the sum falls below this share of the largest one, or below DIVE if that is less.
DIVE_SHARE = 0.05
DIVE = 20
# A shorter line at the border of a part has to be a sentence or a title.
BORDER = 30
# Factor for lines in a part named like an article.
NAMED = 2
# A named element that the page has no surge without holds at least this share of its text.
MOST = 0.5
# A form with more than this share of the text that lies in no other part around the article does not count as one.
FORM_SHARE = 0.5
# A line is a list of links if they make up this share of it.
LINK_SHARE = 0.8

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no markup.
RAW = frozenset("script style noscript template textarea title iframe svg math noembed noframes xmp".split())
OUTSIDE = frozenset("nav footer aside button select menu dialog datalist head object audio video canvas".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright discussion disqus footer legal login masthead menu modal nav navbar navigation newsletter notice "
    "notification pager pagination popup promo promotion recommended related reply replies search share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription toolbar widget".split()
)
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ARTICLE_NAMES = frozenset("article content entry main post story".split())
_HEADINGS = ("header", "hgroup")
_TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
# A name with one of these words tells about the page and not what the element is.
QUALIFIERS = frozenset("no not non has have with without is can ok enabled disabled hide hidden show js".split())
_SENTENCE_END = re.compile(r"[.!?\u2026:;\u3002\uff01\uff1f][\"')\]\u201d\u00bb]*$")

_MARK = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z0-9]+")


@dataclass
class Line:
    """A block: its text, how much of it are links, and whether it belongs to the page around the article."""

    text: str
    links: int
    outside: bool
    # The innermost named element around it, by its place among the marks; -1 without one.
    mark: int
    form: bool
    # 2 inside an article, 1 inside a part named like one.
    inside: int
    title: bool


@dataclass
class Mark:
    """An element whose name says that it is not the article: the named one around it, and whether it holds an article."""

    parent: int
    holds_article: bool = False


@dataclass
class Element:
    name: str
    outside: bool
    mark: int
    form: bool
    inside: int


@dataclass
class Stripper:
    """Goes through the markup once and collects the lines."""

    lines: list[Line] = field(default_factory=list)
    marks: list[Mark] = field(default_factory=list)
    stack: list[Element] = field(default_factory=list)
    # Places of the open elements in the stack, by name, and of all blocks among them.
    places: dict[str, list[int]] = field(default_factory=dict)
    blocks: list[int] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    links: int = 0
    # Whether an article lies in no named element.
    free_article: bool = False

    def top(self) -> Element:
        return self.stack[-1] if self.stack else Element("", False, -1, False, 0)

    def text(self, source: str) -> None:
        if source:
            decoded = html.unescape(source)
            self.pieces.append(decoded)
            if self.links:
                self.linked.append(decoded)

    def end_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.top()
            n_links = len(" ".join("".join(self.linked).split()))
            self.lines.append(Line(text, n_links, top.outside, top.mark, top.form, top.inside, top.name in _TITLES))
        self.pieces.clear()
        self.linked.clear()

    def open(self, name: str, source: str) -> None:
        if name in BLOCKS:
            self.end_line()
            self.close("p")
        if name == "br":
            self.pieces.append(" ")
        if name in VOID:
            return
        parent = self.top()
        outside, named, inside = around(name, source, parent)
        mark = parent.mark
        if name in ("article", "main") and not outside:
            if mark >= 0:
                self.marks[mark].holds_article = True
            elif not named:
                self.free_article = True
        if named:
            self.marks.append(Mark(parent.mark))
            mark = len(self.marks) - 1
        # An article in a form is as good as one outside.
        form = (parent.form or name == "form") and not (name in ("article", "main") and not outside)
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append(Element(name, outside, mark, form, inside))
        self.links += name == "a"

    def close(self, name: str) -> None:
        if name in BLOCKS:
            self.end_line()
        at = (self.places.get(name) or [-1])[-1]
        # A paragraph and what is no block end within the block around them only.
        local = name == "p" or name not in BLOCKS
        if at < 0 or local and self.blocks and self.blocks[-1] > at:
            return
        for element in reversed(self.stack[at:]):
            self.places[element.name].pop()
            if element.name in BLOCKS:
                self.blocks.pop()
            self.links -= element.name == "a"
        del self.stack[at:]

    def run(self, page: str) -> list[Line]:
        at = 0
        lowered = None
        while (mark := _MARK.search(page, at)) is not None:
            self.text(page[at : mark.start()])
            at = mark.end()
            name = (mark[2] or "").lower()
            if not name:
                continue
            if mark[1]:
                self.close(name)
            elif name in RAW:
                if name in BLOCKS:
                    self.end_line()
                if lowered is None:
                    lowered = page.lower() if len(page.lower()) == len(page) else page
                end = lowered.find(f"</{name}", at)
                end = len(page) if end < 0 else page.find(">", end)
                at = len(page) if end < 0 else end + 1
            else:
                self.open(name, mark[3])
        self.text(page[at:])
        self.end_line()
        return self.lines


def around(name: str, source: str, parent: Element) -> tuple[bool, bool, int]:
    """Whether a new element lies outside the article by its kind, whether its name says so, and how far it is inside a marked one."""
    inside = 2 if name in ("article", "main") else parent.inside
    apart = name in OUTSIDE or (name in _HEADINGS and parent.inside < 2)
    if name in ("html", "body") or not source.strip():
        return apart or parent.outside, False, inside
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(source)}
    role, style = found.get("role", ""), found.get("style", "").replace(" ", "")
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
    apart = apart or role in OUTSIDE_ROLES or hidden
    tokens = [_NAME.findall(token) for token in f"{found.get('class', '')} {found.get('id', '')}".split()]
    named = any(OUTSIDE_NAMES.intersection(words) and not QUALIFIERS.intersection(words) for words in tokens)
    if not apart and not named and (role in ("main", "article") or any(ARTICLE_NAMES.intersection(words) for words in tokens)):
        inside = max(inside, 1)
    return apart or parent.outside, named, inside


def marks_that_hold(lines: Sequence[Line], marks: Sequence[Mark], free_article: bool) -> list[bool]:
    """Whether each mark or one around it holds, so that a line under it is not of the article.

    One around an article does not, unless there is an article elsewhere: then it is a list of teasers or comments.
    """
    sizes = [0] * len(marks)
    holds = [mark.holds_article and not free_article for mark in marks]
    for line in lines:
        if line.mark >= 0 and not line.outside:
            sizes[line.mark] += len(line.text)
    for i in range(len(marks) - 1, -1, -1):
        if marks[i].parent >= 0:
            sizes[marks[i].parent] += sizes[i]
            holds[marks[i].parent] |= holds[i]

    def applied(void: Sequence[bool]) -> list[bool]:
        out: list[bool] = []
        for i, mark in enumerate(marks):
            out.append(not void[i] or (mark.parent >= 0 and out[mark.parent]))
        return out

    held = applied(holds)
    without = [0 if line.outside or line.mark >= 0 and held[line.mark] else len(line.text) for line in lines]
    if max(window_sums(without), default=0) < SURGE:
        total = sum(len(line.text) for line in lines if not line.outside)
        held = applied([hold or size >= MOST * total for hold, size in zip(holds, sizes)])
    return held


def kept_lines(lines: Sequence[Line], marks: Sequence[Mark] = (), free_article: bool = False) -> list[str]:
    """Marked articles, and the text between the surges and dives of the window sums."""
    held = marks_that_hold(lines, marks, free_article)
    gone = [line.outside or line.mark >= 0 and held[line.mark] for line in lines]
    around_forms = sum(len(line.text) for line, out in zip(lines, gone) if not out)
    # A form inside an article is never the page itself.
    in_forms = sum(len(line.text) for line, out in zip(lines, gone) if line.form and not out and line.inside < 2)
    page_form = in_forms > FORM_SHARE * around_forms
    kept, article, rest = set(), 0, []
    for i, line in enumerate(lines):
        empty = gone[i] or line.form and (not page_form or line.inside == 2)
        if not line.inside and line.links >= LINK_SHARE * len(line.text):
            empty = True
        if line.inside == 2 and not empty:
            kept.add(i)
            article += len(line.text)
        rest.append(0 if empty or line.inside == 2 else len(line.text) * (NAMED if line.inside else 1))
    for surge, dive in parts(rest, SURGE if article else min(SURGE, max(window_sums(rest), default=0))):
        own = trimmed(lines, [i for i in range(surge, dive) if rest[i]])
        if sum(len(lines[i].text) for i in own) >= article:
            kept.update(own)
    return [line.text for i, line in enumerate(lines) if i in kept]


def trimmed(lines: Sequence[Line], own: list[int]) -> list[int]:
    """``own`` without short lines at both ends that are neither a sentence, nor named, nor a title with text behind it."""

    def solid(i: int) -> bool:
        return len(lines[i].text) >= BORDER or lines[i].inside > 0 or _SENTENCE_END.search(lines[i].text) is not None

    body = [k for k, i in enumerate(own) if solid(i)]
    if not body:
        return own
    first = next((k for k in range(body[0]) if lines[own[k]].title), body[0])
    return own[first : body[-1] + 1]


def window_sums(sizes: Sequence[int]) -> list[int]:
    return [sum(sizes[i : i + WINDOW]) for i in range(len(sizes))]


def parts(sizes: Sequence[int], least: int) -> list[tuple[int, int]]:
    """Surge and dive of each part: the sum rises to ``least`` and a share of the largest one, and falls below a smaller share of it."""
    sums = window_sums(sizes)
    peak = max(sums, default=0)
    high, low = max(least, SURGE_SHARE * peak), min(DIVE, DIVE_SHARE * peak)
    found, at = [], 0
    while at < len(sums):
        if not sums[at] or sums[at] < high:
            at += 1
            continue
        dive = at
        while dive < len(sums) and sums[dive] and sums[dive] >= low:
            dive += 1
        found.append((at, dive))
        at = dive
    return found


def main_text(page: str) -> str:
    stripper = Stripper()
    return " ".join(kept_lines(stripper.run(page), stripper.marks, stripper.free_article))


OUTPUTS = [T.StructField("text", T.StringType())]


def extract(df: DataFrame, page: str = "html", carry: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the main ``text`` of each page."""

    def start():
        return lambda pages: [pa.array(list(map(main_text, pages.to_pylist())), pa.string())]

    return alongside(df, page, OUTPUTS, start, carry)


def texts(df: DataFrame) -> DataFrame:
    found = extract(df.select("page_id", "url", "html"), carry=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
