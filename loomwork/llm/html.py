"""Main text of web pages by the distribution of text over lines of blocks.

Markup is stripped into lines: a block of text each, an empty line at each boundary of a container. A line weighs as much as
it has characters outside links; nothing where it is mostly links, or stands in what never is the article (menus, footers,
forms, adverts, comments ...). Weights are summed over a window sliding along the lines. Where the sums surge, the text is
traced back to where they rose from nothing and on to where they dive to nothing again; of several such stretches the
heaviest is the text. Lines without weight inside it are left out, all others are kept whole.

Names and classes of elements are evidence, no more: they change weights. A cue against an element that holds the page's
first heading and half of its text misleads, and is not heeded. The smallest container that holds nearly all of what is left, its
first heading included (half of it, for an article element), counts for its lines: each of them weighs a surge, and the
sums dive at the container's limits.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


#: Elements by what they mean to the text.
HIDDEN = _names("script style noscript template title textarea iframe object embed svg canvas audio video map select datalist")
BLOCKS = _names(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul"
)
OUTSIDE = _names("nav footer aside form dialog menu head search button input select label")
VOID = _names("area base br col embed hr img input link meta param source track wbr")
HEADINGS = _names("h1 h2 h3 h4 h5 h6 hgroup")
#: Elements whose limits are empty lines; those of them that may be the article's container.
SECTIONS = _names("article aside blockquote body center div dl fieldset figure footer form header main menu nav ol section table ul")
HOLDERS = _names("article center dd div form main section td")
#: Words in class, id and role attributes that mark an element as not of the article.
CUES = _names(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription paywall sidebar sidebars aside widget widgets related recommended recommendations share sharing social "
    "comment comments commentlist disqus reply replies respond discussion reactions breadcrumb breadcrumbs menu menus nav navbar navigation navigationbar "
    "footer foot topbar masthead legal warning rail pagination pager login signin signup search skip copyright disclaimer toolbar complementary contentinfo"
)
#: Elements that such words don't hide, but for the first set: comments may be articles too.
NEVER = _names("html body main h1 h2 h3 h4 h5 h6")
COMMENTS = _names("comment comments commentlist disqus reply replies ad ads advert advertisement sponsored promo related teaser card preview")
#: Words beside a cue that tell a layout ("with-sidebar") and not the thing itself; elements that end an open one of their kind.
LAYOUT = _names("with has no without layout")
ITEMS = _names("li td th tr dt dd option")
#: Elements around the text; what else isn't of the article may stand amid it.
AROUND = _names("nav header footer menu")
#: Elements that a stray end tag doesn't reach beyond.
SCOPES = _names("article main body")

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S,
)
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in HIDDEN}

#: How an element is marked as not of the article: not at all, by its name or a word, by a word for what may hold articles
#: of its own (comments, teasers), by being invisible.
NOT, SOFT, HARD, UNSEEN = range(4)


def cued(name: str, attrs: str, inside: bool = False) -> int:
    """How the attributes mark the element. A header by class counts outside articles only."""
    if not attrs or name in NEVER:
        return NOT
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return UNSEEN
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return UNSEEN
        else:
            words = {w.lower() for w in _PART.findall(value)}
            if words & COMMENTS and (name == "article" or words & COMMENTS & CUES):
                return HARD
            if name != "article" and not words & LAYOUT and (words & CUES or "header" in words and not inside):
                return SOFT
    return NOT


@dataclass
class Line:
    """A block's text, the characters of it outside links, the element it stands in; an empty text at a container's limit."""

    text: str
    weight: int
    element: int


@dataclass
class Element:
    """An element's place in the tree and the lines [first, stop) of it. head: an article's header or in one."""

    name: str
    parent: int
    first: int
    mark: int
    inside: bool
    head: bool
    stop: int = -1


@dataclass
class _Page:
    lines: list[Line] = field(default_factory=list)
    elements: list[Element] = field(default_factory=lambda: [Element("", -1, 0, NOT, False, False)])
    stack: list[int] = field(default_factory=lambda: [0])
    scopes: list[Counter[str]] = field(default_factory=lambda: [Counter()])  # open elements by name since the last scope began
    limits: Counter[str] = field(default_factory=Counter)  # open elements that begin scopes
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def top(self) -> Element:
        return self.elements[self.stack[-1]]

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, len(text) - self.linked if 2 * self.linked < len(text) else 0, self.stack[-1]))  # a line of links is no text
        self.parts, self.linked = [], 0

    def open(self, name: str, mark: int) -> None:
        self.flush()
        top = self.top
        inside = top.inside or name in ("article", "main") and mark < HARD
        head = top.head or name == "header" and top.inside
        if name in SECTIONS:
            self.lines.append(Line("", 0, self.stack[-1]))
        self.elements.append(Element(name, self.stack[-1], len(self.lines), mark, inside, head))
        self.stack.append(len(self.elements) - 1)
        self.scopes[-1][name] += 1
        if name in SCOPES:
            self.scopes.append(Counter())
            self.limits[name] += 1

    def close(self) -> None:
        self.flush()
        e = self.elements[self.stack.pop()]
        e.stop = len(self.lines)
        if e.name in SCOPES:
            self.scopes.pop()
            self.limits[e.name] -= 1
        self.scopes[-1][e.name] -= 1
        if e.name in SECTIONS:
            self.lines.append(Line("", 0, self.stack[-1]))

    def end(self, name: str) -> None:
        """Ends the innermost open element of the name with all in it. An end without a start is ignored, and so is one that
        would reach beyond an article; neither walks the stack."""
        if not (self.scopes[-1][name] or name in SCOPES and self.limits[name]):
            if name in BLOCKS:
                self.flush()
            return
        while True:
            done = self.top.name == name
            self.close()
            if done:
                return


def blocks(page: str) -> _Page:
    """The page's lines and elements in order. Elements that are left open end with their parents."""
    out = _Page()
    links = 0
    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        stop = m.start() if m else len(page)
        if stop > at:
            piece = entities.unescape(page[at:stop])
            out.parts.append(piece)
            if links:
                out.linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if name == "a":
                links = max(0, links - 1)
            else:
                out.end(name)
            continue
        attrs = m["attrs"].rstrip(">")
        if name in HIDDEN:
            if not attrs.endswith("/"):
                end = _END[name].search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "br":
            out.parts.append(" ")
            continue
        if name in ("hr", "input"):
            out.flush()
            continue
        if name in VOID:
            continue
        if name == "a":
            links += 1
            continue
        block = name in BLOCKS or name in OUTSIDE
        if block and (out.top.name == "p" or name == out.top.name and name in ITEMS):  # ends what was left open
            out.close()
        mark = cued(name, attrs, out.top.inside)
        if not (block or mark):
            continue
        if block:
            links = 0
        if mark == NOT and (name in OUTSIDE or name == "header" and not out.top.inside):
            mark = SOFT
        out.open(name, mark)
    while len(out.stack) > 1:
        out.close()
    out.flush()
    out.elements[0].stop = len(out.lines)
    return out


def _sums(lines: list[Line], out: list[bool] | None = None) -> list[int]:
    """Weights of all lines before each place; of those that aren't out, if given."""
    sums = [0]
    for k, line in enumerate(lines):
        sums.append(sums[-1] + (0 if out and out[k] else line.weight))
    return sums


def against(page: _Page) -> list[bool]:
    """Of each line, whether names or words tell that it isn't of the article, and don't mislead."""
    lines, elements = page.lines, page.elements
    size = _sums(lines)
    mass = [size[e.stop] - size[e.first] for e in elements]
    heading = next((k for k, line in enumerate(lines) if line.text and elements[line.element].name == "h1"), -1)
    own = [0] * len(elements)  # what unmarked articles inside hold
    for k in range(len(elements) - 1, 0, -1):
        e = elements[k]
        if e.mark < HARD:
            own[e.parent] += mass[k] if e.name in ("article", "main") and e.mark == NOT else own[k]
    out = [False] * len(elements)
    for k, e in enumerate(elements[1:], 1):
        misleads = e.mark < UNSEEN and e.first <= heading < e.stop and 2 * mass[k] >= size[-1] or e.mark == SOFT and 0 < mass[k] <= 2 * own[k]
        out[k] = out[e.parent] or e.mark != NOT and not misleads
    # of an article's header only headings are text
    return [out[line.element] or elements[line.element].head and elements[line.element].name not in HEADINGS for line in lines]


def inserts(page: _Page, out: list[bool]) -> list[bool]:
    """Of each line, whether it stands in an insert, limits included: a container that isn't of the article, nor around it by
    name, nor of links."""
    lines, elements = page.lines, page.elements
    size = _sums(lines)
    found = [False] * len(lines)
    at = 0
    for e in elements[1:]:
        if e.first >= at and e.mark != NOT and e.name not in AROUND and size[e.stop] > size[e.first] and out[e.first]:
            limit = e.name in SECTIONS
            found[e.first - limit : e.stop + limit] = [True] * (e.stop - e.first + 2 * limit)
            at = e.stop
    return found


def holder(page: _Page, out: list[bool]) -> Element | None:
    """The smallest container that holds nearly all text, or half of it if it is an article, and the first heading; none that
    menus share with the text."""
    lines, elements = page.lines, page.elements
    size = _sums(lines, out)
    if not size[-1]:
        return None
    heading = next((k for k, line in enumerate(lines) if line.text and not out[k] and elements[line.element].name == "h1"), -1)
    shared = {0}
    for e in elements:
        if e.name == "nav":
            k = e.parent
            while k not in shared:
                shared.add(k)
                k = elements[k].parent
    found = None
    for k, e in enumerate(elements):  # parents come before children
        if k in shared or e.name not in HOLDERS or heading >= 0 and not e.first <= heading < e.stop:
            continue
        if (10 if e.name in ("article", "main") else 5) * (size[e.stop] - size[e.first]) >= (5 if e.name in ("article", "main") else 4) * size[-1]:
            found = e
    return found


def stretches(weights: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """Stretches [first, stop) of lines in whose windows the sums surge, from where they rise from nothing to where they dive to
    nothing: no window of nothing is inside."""
    found = []
    some = [k for k, w in enumerate(weights) if w > 0]
    size = [0]
    for w in weights:
        size.append(size[-1] + w)
    start = 0
    for k, at in enumerate(some):
        if k + 1 == len(some) or some[k + 1] - at > window:
            first, stop = some[start], at + 1
            if any(size[min(i + window, stop)] - size[i] >= surge for i in some[start : k + 1]):
                found.append((first, stop))
            start = k + 1
    return found


def chosen(page: _Page, window: int, surge: int) -> list[bool]:
    """Of each line, whether it is of the article."""
    lines, elements = page.lines, page.elements
    out = against(page)
    within = inserts(page, out)
    e = holder(page, out)
    order: list[int] = []  # lines in the sequence; -1 is an empty one
    weights: list[int] = []
    for k, line in enumerate(lines):
        inside = e is not None and e.first <= k < e.stop
        if e is not None and k in (e.first, e.stop):
            order += [-1] * window
            weights += [0] * window
        if inside and (out[k] or not line.text) or within[k]:
            continue
        order.append(k)
        weights.append(0 if out[k] else max(line.weight, surge) if inside else line.weight)
    size = [0]
    for w in weights:
        size.append(size[-1] + w)
    most = max((size[min(i + window, len(weights))] - size[i] for i in range(len(weights))), default=0)
    found = stretches(weights, window, max(1, min(surge, most)))
    keep = [False] * len(lines)
    if found:
        first, stop = max(found, key=lambda s: (size[s[1]] - size[s[0]], -s[0]))
        if e is None:  # a heading begins the text, unless as much stands before it
            title = next((i for i in range(first, stop) if order[i] >= 0 and elements[lines[order[i]].element].name == "h1" and not out[order[i]]), first)
            first = title if size[title] - size[first] < surge else first
        for i in range(first, stop):
            if order[i] >= 0 and not out[order[i]]:
                keep[order[i]] = bool(lines[order[i]].text)
    return keep


def main_text(page: str | None, *, window: int = 3, surge: int = 86) -> str:
    """Text blocks of the article, joined by line breaks; empty if there are none."""
    found = blocks(page or "")
    return "\n".join(line.text for line, keep in zip(found.lines, chosen(found, window, surge), strict=True) if keep)


def extract(pages: DataFrame, *, html: str = "html", window: int = 3, surge: int = 86, out: str = "text") -> DataFrame:
    """pages with the column ``out``: the main text of the page, read whole. A null or empty page and one without an
    article have an empty text. White space inside a block, however written, is one space. Rows and columns stay."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(x, window=window, surge=surge) for x in batch], dtype=object)

    return pages.withColumn(free(out, pages.columns), run(F.col(html).cast("string")))
