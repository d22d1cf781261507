"""Main text of HTML pages by text-to-tag ratios of lines, from the events of the standard parser.

The parser's events cut a page into lines: a line is the text between two edges of block
elements.  A line's ratio is its characters outside of links over its tags.  Ratios are
smoothed with a Gaussian over neighbouring lines, and lines above the standard deviation of
all are the core.  The core clusters in an element of the page: from the root down, as long
as one child holds most of it.  That element's lines are the content region; where it is the
whole page, the region goes from the first core line to the last.

Elements that say what they are (menus, forms, adverts, comments …) by their tag, role, class
or id have a ratio of zero and never belong to the region.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caseloom.llm.batches import add_columns

RADIUS, SIGMA = 2, 1.0  # lines over which ratios are smoothed
MOST = 0.75  # share of the core that an element must hold
MAIN_WEIGHT = 8  # of characters in an element that calls itself the article

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a line.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option optgroup p pre section select summary table tbody "
    "template textarea tfoot thead title tr ul iframe object svg audio video canvas noframes script style search".split()
)
#: Elements that are closed by the next one of the same group, or by any block where the list says so.
CLOSED_BY = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"}}
#: Elements whose text is never an article's, by what they are.
TAGS = {
    "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "form": "form", "dialog": "notice", "search": "form",
    **dict.fromkeys("head title script style noscript template iframe object svg audio video canvas noframes select button textarea option".split(), "code"),
}
ROLES = {"navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "sidebar", "search": "form", "form": "form", "dialog": "notice", "alertdialog": "notice", "alert": "notice"}
#: Words in class and id attributes.
WORDS = {
    word: kind
    for kind, words in {
        "menu": "nav navbar navigation menu menubar topbar toolbar breadcrumb breadcrumbs pagination pager toc skip",
        "header": "header masthead",
        "footer": "footer copyright colophon legal",
        "sidebar": "sidebar aside widget widgets related recommended recommendations trending popular share sharing social newsletter subscribe subscription",
        "notice": "notice notices cookie cookies gdpr consent banner popup modal overlay toast alert",
        "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted",
        "comments": "comment comments commentary reply replies respond disqus discussion",
        "form": "login signin signup register search",
    }.items()
    for word in words.split()
}
#: With these, a class tells of a page that has such a thing, or of the head of an article.
NOT_ITSELF = frozenset("has no not with without hide is".split())
OF_ARTICLE = frozenset("article content entry post story".split())
#: What an article inside of it cancels: the element is the frame of the whole page.
FRAMES = frozenset(["menu", "header", "form", "notice"])
MAIN = frozenset(["article", "main"])
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _kind(tag: str, attrs: list[tuple[str, str | None]], in_main: bool) -> str | None:
    """What an element that is not content says it is."""
    kind = TAGS.get(tag)
    if kind == "header" and in_main:
        kind = None
    if kind or tag in ("html", "body", *MAIN) and not attrs:
        return kind
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and re.search(r"display\s*:\s*none", value):
            return "code"
        if name == "role" and value in ROLES and not (in_main and ROLES[value] == "header"):
            return ROLES[value]
        if name in ("class", "id") and value and tag not in ("html", "body", "main"):
            for one in value.split():
                words = [w.lower() for w in _WORD.findall(one)]
                for i, word in enumerate(words):
                    found = WORDS.get(word)
                    if not found or i and words[i - 1] in NOT_ITSELF:
                        continue
                    if found == "header" and (in_main or OF_ARTICLE.intersection(words)):
                        continue
                    return found
    return None


class _Line:
    __slots__ = ("parts", "tags", "linked", "path", "kind", "main", "heading")

    def __init__(self, path: tuple[int, ...], kind: str | None, main: bool, heading: bool):
        self.parts: list[str] = []
        self.tags, self.linked = 0, 0
        self.path, self.kind, self.main, self.heading = path, kind, main, heading


class _Lines(HTMLParser):
    """Lines of a page from its events; open block elements are a stack of ``tag, number, kind, main``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, str | None, bool]] = []
        self.path: tuple[int, ...] = ()
        self.elements, self.in_link = 0, False
        self.lines: list[_Line] = []
        self.cut()

    def cut(self) -> None:
        kind, main = self.open[-1][2:] if self.open else (None, False)
        if self.lines and not self.lines[-1].parts:
            self.lines.pop()
        self.lines.append(_Line(self.path, kind, main, bool(self.open) and self.open[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6")))

    def close_to(self, at: int) -> None:
        self.open = self.open[:at]
        self.path = tuple(x[1] for x in self.open)
        self.in_link = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            while self.open and tag in CLOSED_BY.get(self.open[-1][0], ()):
                self.close_to(len(self.open) - 1)
            if tag not in VOID:
                outer, main = self.open[-1][2:] if self.open else (None, False)
                own = _kind(tag, attrs, main)
                said = tag in MAIN or ("role", "main") in attrs or ("itemprop", "articleBody") in attrs
                if said and own is None and outer in FRAMES:
                    outer = None
                kind = own if own and outer == "form" else outer or own
                self.elements += 1
                self.open.append((tag, self.elements, kind, main or said and not kind))
                self.path = (*self.path, self.elements)
            self.cut()
        elif tag == "a":
            self.in_link = True
        if tag in ("br", "td", "th"):
            self.lines[-1].parts.append(" ")
        self.lines[-1].tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == tag:
                    self.close_to(at)
                    break
            self.cut()
        elif tag == "a":
            self.in_link = False
        self.lines[-1].tags += 1

    def handle_data(self, data: str) -> None:
        line = self.lines[-1]
        line.parts.append(data)
        if self.in_link:
            line.linked += len(data.strip())


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Each ratio as the Gaussian mean of its neighbours; beyond the ends there are none."""
    weight = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    over = np.convolve(np.ones(len(ratios)), weight)[RADIUS : RADIUS + len(ratios)]
    return np.convolve(ratios, weight)[RADIUS : RADIUS + len(ratios)] / over


def _region(lines: list[_Line], texts: list[str], plain: np.ndarray, ratios: np.ndarray) -> list[str]:
    """The texts of the content region; ``plain`` says which lines may be part of it."""
    smooth = smoothed(ratios)
    core = plain & (smooth >= smooth.std()) & (smooth > 0)
    if not core.any():  # links only: an article is content all the same
        core = plain & np.array([x.main for x in lines])
    weight = np.array([len(t) * (MAIN_WEIGHT if x.main else 1) for t, x in zip(texts, lines)])
    chosen = np.flatnonzero(core)
    inside, depth = list(chosen), 0
    total = weight[chosen].sum()
    while True:  # into the child that holds most of the core
        held: dict[int, int] = {}
        for i in inside:
            if len(lines[i].path) > depth:
                held[lines[i].path[depth]] = held.get(lines[i].path[depth], 0) + int(weight[i])
        best = max(held, key=held.get, default=None)
        if best is None or held[best] < MOST * total:
            break
        deeper = [i for i in inside if len(lines[i].path) > depth and lines[i].path[depth] == best]
        if all(len(lines[i].path) == depth + 1 for i in deeper) and len({lines[i].path for i in deeper}) == 1 and len(deeper) == 1:
            break  # a single line's own block; its parent is the region
        inside, depth = deeper, depth + 1
    region = lines[inside[0]].path[:depth] if inside else ()
    said = any(lines[i].main for i in inside)
    if depth > 2 or said:
        at = [i for i, x in enumerate(lines) if x.path[:depth] == region]
    else:  # the whole page: what lies between the core's ends
        at = list(range(chosen[0], chosen[-1] + 1)) if len(chosen) else []
    linked = [2 * x.linked > len(t) and not x.heading for x, t in zip(lines, texts)]
    at = [i for i in at if plain[i] and (core[i] or not linked[i])]
    while at and not said and linked[at[-1]]:  # lists of links before and after are no part of it
        at.pop()
    while at and not said and linked[at[0]]:
        at.pop(0)
    before = at[0] - 1 if at else -1
    while before >= 0 and (not texts[before] or plain[before] and lines[before].heading):  # its title may stand outside
        at.insert(0, before)
        before -= 1
    return [texts[i] for i in at if texts[i]]


def main_text(html: str | None) -> str:
    """The blocks of a page's article, white space in them turned into one space, joined by line ends."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    lines = parser.lines
    texts = [" ".join("".join(x.parts).split()) for x in lines]
    for skipped in ((None,), (None, "form")):  # a form around the whole page only if there is nothing else
        plain = np.array([bool(t) and x.kind in skipped for t, x in zip(texts, lines)], bool)
        if plain.any():
            ratios = np.array([max(0, len(t) - x.linked) / max(1, x.tags) for t, x in zip(texts, lines)])
            return "\n".join(_region(lines, texts, plain, np.where(plain, ratios, 0.0)))
    return ""


def extract(pages: DataFrame, html_col: str = "html", name: str = "text", size: str = "n_chars", keep_html: bool = True) -> DataFrame:
    """Adds the main text of each page and its length in code points to every row and column of ``pages``.

    Null pages and pages without text give the empty text.  Whole pages are parsed, however
    long; rows that repeat give equal texts; an empty table gives no rows; columns called
    like the new ones are replaced.
    """

    def made(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [main_text(h) for h in batch.column(html_col).to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return add_columns(pages, made, f"{name} string, {size} long", html_col, keep_html)
