"""Main text of web pages by text-to-tag ratios.

One pass of the standard library's event parser turns a page into lines: a block element's own text, white
space turned into single spaces, in page order. Each line has a text-to-tag ratio (its characters over the
tags opened or closed while it was read). The ratios, smoothed with a Gaussian, fall in two clusters:
lines over a threshold between the cluster means are content. Regions hold all of them: every ``article`` or ``main``, if these hold
most of the content's characters, with the smallest elements around the content lines elsewhere; else the smallest
element that holds all content lines. All lines of the regions are the main text, short ones too, except lines of links under the threshold
that stand in no running text (menus without a name) and those in elements that are never the article: menus, headers and
footers of the page, sidebars, forms, notices, adverts, reader comments, scripts and styles, known by
element, ARIA role or words of the class or id. Forms and such words exclude an element only if it does not hold most of
the page's content, and words exclude no heading or section within the region. An element left open before the article is closed
by it, or counts for nothing if it holds most of the page and that is not links.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import body, text_chunks

# Fixed values of HTML: elements without content, elements that flow inside a line, and those whose text is never shown.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
HEAD = set("base basefont bgsound link meta title noscript script style template head html".split())  # what does not close the head
HIDDEN = set("script style noscript template head title iframe object svg canvas audio video math".split())
# Elements and roles that are never the article.
OUTSIDE = set("nav aside button select textarea input dialog menu fieldset".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar note".split())
# Parts of a page that its article may also have: they are outside unless they stand in the article.
PAGE_PARTS = {"header", "footer"}
# Words of a class or id, split at what is no letter and at changes of case.
MARKED = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer masthead "
    "share sharing social newsletter subscribe subscription signup login search widget widgets "
    "related recommended recommendations pager pagination toolbar skip copyright legal disclaimer form".split()
)
COMMENTS = set("comment comments commentlist disqus replies reply respond".split())
# Opening one of these closes an open paragraph, as browsers do.
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
# An element closes an open one of its kind, within the nearest of the containers.
CLOSES_OWN = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ROOTS = ("article", "main")
BLANKS = re.compile(r"\s+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SIGMA = 1.0
# Articles are the main regions if they hold this share of the content lines' characters.
ARTICLE_SHARE = 0.5
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# A marked element that holds more than this share of the page's content is not outside for its mark.
MOST = 0.5
# How surely an element is not the article: not at all, by its class or as a form (an article in it counts all the same), by its
# element or role, as reader comments.
WITHIN, MARKED_OUT, OUT, SURELY_OUT = 0, 1, 2, 3
# A line is links if they hold more than this share of its characters.
LINKS = 0.8
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
# What an opening article or main closes: it never stands in them. The second may hold teasers that are articles.
ENDED_BY_ARTICLE = set("nav button select textarea menu fieldset".split())
ENDED_BY_MAIN = ENDED_BY_ARTICLE | {"aside", "dialog"}


class Line:
    """A block element's own text: its tags, its element's number, and how many of its characters stand in links."""

    __slots__ = ("text", "tags", "element", "linked")

    def __init__(self, text: str, tags: int, element: int, linked: int):
        self.text, self.tags, self.element, self.linked = text, tags, element, linked


class Lines(HTMLParser):
    """Parser events to lines. Elements are numbered in page order, so a parent's number is below its children's; ``names``,
    ``marks`` and ``parents`` are by number. Every event takes constant time, however many elements are open: ``places`` has
    for each name where on the stack it is open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # element, number, hidden
        self.places: dict[str, list[int]] = {}
        self.names: list[str] = ["#page"]
        self.marks, self.parents = [WITHIN], [0]
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def _hidden(self) -> bool:
        return bool(self.stack) and self.stack[-1][2]

    def _in_head(self) -> bool:
        return bool(self.stack) and self.stack[-1][0] == "head"

    def _place(self, names) -> int:
        """Where on the stack the innermost open element of these names is; -1 if none is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def end_line(self) -> None:
        text = BLANKS.sub(" ", "".join(self.parts)).strip()
        self.parts = []
        if text:
            self.lines.append(Line(text, self.tags, self.stack[-1][1] if self.stack else 0, self.linked))
            self.tags = 0
        self.linked = 0

    def _close(self, place: int) -> None:
        if any(e[0] not in INLINE for e in self.stack[place:]):
            self.end_line()
        for name, _, _ in reversed(self.stack[place:]):
            self.places[name].pop()
        del self.stack[place:]

    def _pop(self, tag: str, stop: set[str]) -> None:
        """Close the innermost open ``tag`` and all in it, unless one of ``stop`` is open further in."""
        place = self._place((tag,))
        if place >= 0 and place >= self._place(stop):
            self._close(place)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        if tag == "body" or self._in_head() and tag not in HEAD:
            self._pop("head", {"template"})
        if tag == "head" and (self.lines or self.places.get("body")):
            return
        if tag in CLOSES_P:
            self._pop("p", {"table", "td", "th", "button", "object"} | OUTSIDE)
        if tag in CLOSES_OWN:
            own, stop = CLOSES_OWN[tag]
            for name in own:
                self._pop(name, stop - {name})
        if tag in ROOTS:
            # Left open before the article; only what is open within an article already is left alone.
            ended = ENDED_BY_MAIN if tag == "main" else ENDED_BY_ARTICLE
            inside = self._place(ROOTS)
            first = min((p for n in ended for p in self.places.get(n, ()) if p > inside), default=-1)
            if first >= 0:
                self._close(first)
        if tag not in INLINE:
            self.end_line()
        if tag in VOID:
            return
        known = dict(attrs)
        mark = WITHIN
        if tag in OUTSIDE or (known.get("role") or "").lower() in ROLES:
            mark = OUT
        elif tag in PAGE_PARTS and self._place(ROOTS) < 0:
            mark = OUT
        elif tag not in ("html", "body", "main"):
            words = {w.lower() for w in NAME_PARTS.findall(f"{known.get('class') or ''} {known.get('id') or ''}")}
            words -= {"ad"} if "hoc" in words else set()
            form = tag == "form" or (known.get("role") or "").lower() == "form"
            mark = SURELY_OUT if words & COMMENTS else MARKED_OUT if form or words & MARKED else WITHIN
        hidden = self._hidden() or tag in HIDDEN or "hidden" in known or (known.get("aria-hidden") or "").lower() == "true"
        hidden = hidden or bool(UNSEEN.search(known.get("style") or ""))
        self.parents.append(self.stack[-1][1] if self.stack else 0)
        self.names.append(tag)
        self.marks.append(mark)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, len(self.names) - 1, hidden))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash of an element that is not void

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "p" and not self.places.get("p"):
            self.end_line()
        else:
            self._pop(tag, set())

    def handle_data(self, data: str) -> None:
        if self._in_head() and not data.isspace():
            self._pop("head", set())
        if not self._hidden():
            self.parts.append(data)
            if self.places.get("a"):
                self.linked += len(data.strip())

    def below(self, chosen) -> list[bool]:
        """For every element whether it or one that it stands in is chosen."""
        found = [0 in chosen]
        for number in range(1, len(self.names)):
            found.append(number in chosen or found[self.parents[number]])
        return found

    def held(self, own: dict[int, int]) -> list[int]:
        """Sums by element, those of the elements in it included."""
        total = [own.get(number, 0) for number in range(len(self.names))]
        for number in range(len(total) - 1, 0, -1):
            total[self.parents[number]] += total[number]
        return total


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; at the ends the kernel is cut and scaled to one."""
    reach = math.ceil(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel)[reach:reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The middle between the means of two clusters, moved until it stays."""
    split = float(values.mean())
    while True:
        low, high = values[values <= split], values[values > split]
        moved = (float(low.mean()) + float(high.mean())) / 2 if len(low) and len(high) else split
        if abs(moved - split) < 1e-9:
            return split
        split = moved


def outside(parser: Lines, void: set[int]) -> list[int]:
    """How surely each element is outside, the marks of ``void`` not counted."""
    found = [WITHIN]
    for number in range(1, len(parser.names)):
        own = WITHIN if number in void else parser.marks[number]
        above = found[parser.parents[number]]
        found.append(max(own, WITHIN if above == MARKED_OUT and parser.names[number] in ROOTS else above))
    return found


def _sizes(lines: list[Line], size=lambda line: len(line.text)) -> dict[int, int]:
    found: dict[int, int] = {}
    for line in lines:
        found[line.element] = found.get(line.element, 0) + size(line)
    return found


def wrappers(parser: Lines, lines: list[Line], mark: int) -> set[int]:
    """Elements with this mark that hold most characters of the lines, and mostly no links."""
    held, linked = parser.held(_sizes(lines)), parser.held(_sizes(lines, lambda line: line.linked))
    total = held[0]
    return {n for n, m in enumerate(parser.marks) if m == mark and held[n] > MOST * total and (mark == MARKED_OUT or 2 * linked[n] < held[n])}


def block_of(parser: Lines, element: int) -> int:
    """The innermost element around that may hold several lines."""
    while parser.names[element] in LINE_ELEMENTS:
        element = parser.parents[element]
    return element


def regions(parser: Lines, shown: list[int], content: list[int]) -> tuple[set[int], set[int]]:
    """Elements whose lines are the main text, and content lines that stand in none of them."""
    lines, names = parser.lines, parser.names
    all_roots = {n for n, name in enumerate(names) if name in ROOTS}
    seen = parser.held({lines[i].element: 1 for i in shown})
    roots = {n for n in all_roots if seen[n]}
    rooted = parser.below(roots)
    elsewhere = [i for i in content if not rooted[lines[i].element]]
    rest, total = sum(len(lines[i].text) for i in elsewhere), sum(len(lines[i].text) for i in content)
    if not roots or rest > (1 - ARTICLE_SHARE) * total:
        # Elements are numbered in page order, so the last that holds all content is the innermost.
        held = parser.held(_sizes([lines[i] for i in content], lambda line: 1))
        return roots | {max(n for n, count in enumerate(held) if count == len(content) and names[n] not in LINE_ELEMENTS)}, set()
    # Content beside the articles brings the lines of its element, unless that is around an article or the page.
    around = parser.held({lines[i].element: 1 for i in shown if rooted[lines[i].element]})
    found, single = set(roots), set()
    for i in elsewhere:
        own = block_of(parser, lines[i].element)
        if around[own] or names[own] in ("#page", "html", "body"):
            single.add(i)
        else:
            found.add(own)
    return found, single


def main_text(page: str) -> str:
    parser = Lines()
    parser.feed(page)
    parser.close()
    parser.end_line()
    lines = parser.lines
    if not lines:
        return ""
    ratios = smoothed(np.array([len(line.text) / max(1, line.tags) for line in lines], dtype=float))
    least = threshold(ratios)
    over = [line for line, ratio in zip(lines, ratios) if ratio >= least]
    # An element that is never the article by its name, but holds most of the page that is no links, was left open.
    void = wrappers(parser, lines, OUT) & wrappers(parser, over or lines, OUT)
    surely = outside(parser, void)
    possible = [(line, ratio >= least) for line, ratio in zip(lines, ratios) if surely[line.element] < OUT]
    # A wrapper holds most of the content and most of all text: a long aside of a short article is none.
    marked = wrappers(parser, [line for line, _ in possible], MARKED_OUT)
    void |= marked & wrappers(parser, [line for line, high in possible if high] or [line for line, _ in possible], MARKED_OUT)
    out = outside(parser, void)
    shown = [i for i, line in enumerate(lines) if not out[line.element]]
    if not shown:
        return ""
    content = [i for i in shown if ratios[i] >= least] or shown
    region, single = regions(parser, shown, content)
    # Headings and sections of the region are the article's, whatever they are called.
    inner = parser.below({n for n in region if parser.names[n] not in ("#page", "html", "body")})
    named = {
        n for n, tag in enumerate(parser.names)
        if parser.marks[n] == MARKED_OUT and (tag in HEADINGS or tag == "section") and inner[parser.parents[n]]
    }
    if named:
        out = outside(parser, void | named)
    within = parser.below(region)
    kept = [i for i, line in enumerate(lines) if not out[line.element] and (i in single or within[line.element])]
    return "\n\n".join(lines[i].text for i in without_menus(parser, kept, ratios >= least))


def without_menus(parser: Lines, kept: list[int], high: np.ndarray) -> list[int]:
    """The lines but those under the threshold that are links and do not stand between two lines over it. Headings stay."""
    found = []
    for at, i in enumerate(kept):
        line = parser.lines[i]
        links = line.linked > LINKS * len(line.text) and not high[i] and parser.names[line.element] not in HEADINGS
        if not links or 0 < at < len(kept) - 1 and high[kept[at - 1]] and high[kept[at + 1]]:
            found.append(i)
    return found


# Elements that are a line by themselves: a region is one that may hold several.
LINE_ELEMENTS = set("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr figcaption caption".split()) | INLINE


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row; ``text`` is empty if a page has none, ``n_chars`` counts
    code points.

    Null and empty pages give an empty text; broken markup is read as browsers do, as far as the event parser sees
    it; repeated rows are read each; other columns are not read. Scan tasks work alone: no shuffle, a page at a time."""
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), body(F.col(html)).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "html"):
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
