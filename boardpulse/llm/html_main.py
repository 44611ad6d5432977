"""Main text of pages by the distribution of text over lines.

A page becomes lines: every block element starts one, and an element that is no
part of the article (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, comments) leaves a gap of empty lines. Lines that are mostly links have
no weight. The text lengths of a sliding window of lines are summed: where the sum
surges from nothing, a stretch of text begins, and where it dives to nothing, one
ends. If the page marks its article, the stretches inside it are kept; else all
that are not mostly links themselves, however short. A missing end tag ends a
left-out element where HTML lets it: at the next sibling or its parent's end.
"""

from __future__ import annotations

import html as html_entities
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from boardpulse.llm.batches import by_text_size, map_batches

#: Lines of the sliding window, and so the empty lines that end a stretch.
WINDOW = 3
#: Without a marked article: the share of link text from which a line has no weight, and a stretch is left out.
LINK_SHARE = 0.5

# Names of elements and of classes, ids and roles.
_RAW = frozenset("script style textarea title noscript iframe".split())
_OUT = frozenset("head nav header footer aside form button select option svg canvas object template dialog menu script style textarea title noscript iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_NAMES = re.compile(
    r"(?:^|[\s_-])(ads?|advert\w*|sponsor\w*|promo\w*|banner|menu|nav|navbar|navigation|breadcrumbs?|sidebar|aside|widget|related|footer|header|"
    r"masthead|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|share|social|search|login|"
    r"comments?|commentlist|respond|replies|complementary|contentinfo)(?=$|[\s_-])",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.IGNORECASE)
_HIDDEN = re.compile(r"\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_PROTECTED = frozenset("html body main article".split())
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
_CLOSE_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main "
    "menu nav ol p pre section summary table ul li dd dt".split()
)
_CELLS, _PARTS = frozenset("td th tr tbody thead tfoot".split()), frozenset("tr tbody thead tfoot".split())
#: Elements whose end tag may be missing: the start tags that end them, and the elements in between that prevent it.
_ENDED_BY = {
    "head": (None, frozenset()),
    "p": (_CLOSE_P, frozenset(["button", "table", "object"])),
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (_CELLS, frozenset(["table"])),
    "th": (_CELLS, frozenset(["table"])),
    "tr": (_PARTS, frozenset(["table"])),
}


class _Lines:
    """Lines of text with the size of their link text, and whether they stand in a marked article."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.inside: list[bool] = []
        self.linked: list[int] = []
        self.now: list[str] = []
        self.link_chars = 0

    def add(self, text: str, linked: bool) -> None:
        self.now.append(text)
        if linked:
            self.link_chars += len(text.strip())

    def end(self, inside: bool) -> None:
        if self.now:
            text = " ".join(html_entities.unescape("".join(self.now)).split())
            if text:
                self.texts.append(text)
                self.inside.append(inside)
                self.linked.append(min(self.link_chars, len(text)))
            self.now, self.link_chars = [], 0

    def gap(self) -> None:
        self.texts += [""] * WINDOW
        self.inside += [False] * WINDOW
        self.linked += [0] * WINDOW


def _enders() -> dict[str, list[tuple[str, frozenset[str]]]]:
    """For a start tag, the open elements that it ends and what in between prevents it."""
    found: dict[str, list[tuple[str, frozenset[str]]]] = {}
    for element, (by, held) in _ENDED_BY.items():
        for name in by or ():
            found.setdefault(name, []).append((element, held))
    return found


_ENDS = _enders()


class _Open:
    """Open elements from the first left-out one on, and where those of each name stand; a tag costs the same at any depth."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}

    def push(self, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def cut(self, place: int) -> None:
        """Closes all from a place on."""
        while len(self.names) > place:
            self.places[self.names.pop()].pop()

    def last(self, name: str) -> int:
        return self.places[name][-1] if self.places.get(name) else -1

    def end_by_start(self, name: str) -> None:
        """Closes those elements that a start tag of that name ends."""
        head = [] if name in _IN_HEAD else [("head", frozenset())]
        ended = True
        while ended:
            ended = False
            for element, held in [*_ENDS.get(name, ()), *head]:
                places = self.places.get(element, [])
                first = bisect_right(places, max((self.last(h) for h in held), default=-1))
                if first < len(places):
                    self.cut(places[first])
                    ended = True


def page_lines(page: str) -> tuple[list[str], list[bool], list[int]]:
    """Lines of a page, and for each whether it stands in a marked article and how much of it is link text."""
    lines = _Lines()
    out_of = _Open()
    around: Counter[str] = Counter()  # open elements that are not left out
    articles = links = 0
    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if out_of.names == ["head"] and text.strip():
            out_of.cut(0)
        if text and not out_of.names:
            lines.add(text, links > 0)
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if closing:
            if out_of.names:
                if out_of.last(name) >= 0:
                    out_of.cut(out_of.last(name))
                    continue
                if name in _INLINE or not around[name]:
                    continue
                out_of.cut(0)  # the end of an element around it
            around[name] = max(0, around[name] - 1)
            if name in ("article", "main"):
                lines.end(articles > 0)
                articles = max(0, articles - 1)
            elif name == "a":
                links = max(0, links - 1)
            elif name not in _INLINE:
                lines.end(articles > 0)
            continue
        empty = name in _VOID or attributes.endswith("/")
        if name in _RAW:
            end = re.compile(f"</{name}[^>]*+>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            if not out_of.names:
                lines.add(" ", False)
            continue
        if out_of.names:
            out_of.end_by_start(name)
        if out_of.names:
            if not empty:
                out_of.push(name)
            continue
        unwanted = name in _OUT or (name not in _PROTECTED and attributes and _is_unwanted(attributes))
        comment = name in _PROTECTED and articles and attributes and _is_unwanted(attributes)
        if (unwanted or comment) and not empty:
            lines.end(articles > 0)
            lines.gap()
            out_of.push(name)
            continue
        if not empty:
            around[name] += 1
        if name in ("article", "main"):
            lines.end(articles > 0)
            articles += 1
        elif name == "a":
            links = 0 if empty else 1
        elif name in ("br", "wbr", "img"):
            lines.add(" " if name == "br" else "", False)
        elif name not in _INLINE:
            lines.end(articles > 0)
    lines.end(articles > 0)
    return lines.texts, lines.inside, lines.linked


def _is_unwanted(attributes: str) -> bool:
    values = (m[1] or m[2] or m[3] or "" for m in _ATTRIBUTE.finditer(attributes))
    return any(_NAMES.search(v) for v in values) or bool(_HIDDEN.search(attributes))


def stretches(lengths: list[int]) -> list[tuple[int, int]]:
    """[begin, end) of each stretch: from a surge of the windowed sums to the dive after it."""
    before = [0, *accumulate(lengths)]
    sums = [before[min(i + WINDOW, len(lengths))] - before[i] for i in range(len(lengths))]
    found, begin = [], None
    for i, total in enumerate(sums):
        if begin is None and lengths[i]:
            begin = i
        elif begin is not None and not total:
            found.append((begin, i))
            begin = None
    if begin is not None:
        found.append((begin, len(lengths)))
    return found


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by an empty line; empty if there is none."""
    texts, inside, linked = page_lines(page or "")
    marked = any(i and t for i, t in zip(inside, texts, strict=True))
    if marked:
        texts = [t if i else "" for t, i in zip(texts, inside, strict=True)]
    lengths = [len(t) if marked or n <= LINK_SHARE * len(t) else 0 for t, n in zip(texts, linked, strict=True)]
    kept = []
    for a, b in stretches(lengths):
        if marked or sum(linked[a:b]) <= LINK_SHARE * sum(map(len, texts[a:b])):
            kept += [t for t in texts[a:b] if t]
    return "\n\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html)``.

    The whole page is read. A null page and one without text give an empty text.
    Nulls in the other columns stay; repeated rows stay; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_text_size(batches, "html"):
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
