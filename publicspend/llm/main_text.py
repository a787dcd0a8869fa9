"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped and every block of the page becomes a line. A line weighs as many characters
as it has outside links; lines of menus, forms, notices and the like weigh nothing. The sums of
weights over a sliding window rise in the article (the surge) and fall to nothing where it ends, on
both sides (the dive). The lines between are its text. Blank lines do not count. Article and main
elements bound the stretches and join those in them, but a surge decides whether their text is taken
at all. In them an element whose class only hints at something else, as in ``comment-list``, is left
out unless it holds most of their text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from publicspend.llm.common import mapped, take

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol option p pre section select summary table tbody td textarea tfoot th thead title tr "
    "ul".split()
)
#: Elements that are never part of an article.
ASIDE = frozenset("nav footer aside form button select menu dialog head noscript".split())
#: Elements whose content is not markup; it ends at their own end tag only.
RAW = frozenset("script style textarea title iframe noscript template svg object".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
CONTAINERS = frozenset(("article", "main"))
#: Words in class, id or role that mark what is not part of an article.
NOTES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies "
    "consent notice notices alert sidebar menu navbar nav navigation breadcrumb breadcrumbs footer "
    "comment comments disqus reply replies respond social share sharing related newsletter "
    "subscribe subscription popup modal widget login signup search complementary contentinfo "
    "toolbar".split()
)
#: Words for parts of a page. A name made of these and of notes hints at an element's place, while
#: with other words it may be a subject of the article, as in ``navigation-systems``.
PARTS = frozenset(
    "list listing area section container wrapper wrap box block panel group button buttons bar row "
    "col column signup form post posts article articles story stories link links item items entry "
    "page site main content body inner outer js top bottom left right head title thread feed count "
    "icon icons unit slot zone us this now more user users reader readers".split()
)
#: The same, but only outside articles.
OUTER_NOTES = frozenset(("header", "masthead", "topbar"))

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
#: Elements that hold blocks. In articles only these can be noted, by a whole class or role.
HOLDERS = frozenset("article main div section li ul ol dl table details fieldset figure center".split())

_MARKS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKENS = re.compile(
    r"(?<![\w-])(?:class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)
_WORDS = re.compile(r"[a-z]+")
_HUMP = re.compile(r"([a-z])([A-Z])")


@dataclass(frozen=True)
class BlockRules:
    """Lines of text in a ``window``; a surge passes ``surge`` characters, or ``share`` of the page's
    highest sum where that is less."""

    window: int = 3
    surge: int = 80
    share: float = 0.25


@dataclass
class _Line:
    text: str
    plain: int
    aside: int  # NOT, HINTED or SURE
    container: int  # number of the outermost article or main element, 0 outside


NOT, HINTED, SURE = range(3)


def _noted(tag: str, attributes: str, inside: bool) -> int:
    """How surely an element starts something beside the article.

    Outside articles any word of a class, id or role tells; the id of a heading, say, may be any
    word of its text, so inside only a class or role of an element that holds blocks does. A whole
    class is sure, a word of one is a hint.
    """
    if tag in ASIDE or (tag == "header" and not inside):
        return SURE
    if inside:
        found = NOT
        for mark in _TOKENS.finditer(attributes) if tag in HOLDERS else ():
            for name in (mark[1] or mark[2] or mark[3] or "").split():
                if name.lower() in NOTES:
                    return SURE
                words = set(_WORDS.findall(_HUMP.sub(r"\1 \2", name).lower()))
                if words & NOTES and words <= NOTES | PARTS:
                    found = HINTED
        return found
    for mark in _MARKS.finditer(attributes):
        words = set(_WORDS.findall((mark[1] or mark[2] or mark[3] or "").lower()))
        if words & NOTES or words & OUTER_NOTES:
            return SURE
    return NOT


def lines_of(page: str) -> list[_Line]:
    """The page's blocks in order, with what the distribution needs to know of each."""
    lines: list[_Line] = []
    parts: list[str] = []
    plain = links = containers = opened = 0
    aside: str | None = None  # the element that started a stretch beside the article
    depth = place = 0
    sure = NOT  # how surely it does
    within = ""  # of a hint, an element inside that is sure
    deeper = 0

    def close() -> None:
        nonlocal plain
        text = " ".join("".join(parts).split())
        lines.append(_Line(text, plain, SURE if within else sure, opened if containers else 0))
        parts.clear()
        plain = 0

    def add(text: str) -> None:
        nonlocal plain
        if text:
            text = html.unescape(text)
            parts.append(text)
            if not links:
                plain += sum(map(len, text.split()))

    while token := _TOKEN.search(page, place):
        add(page[place : token.start()])
        place = token.end()
        end, name = (token[1], token[2]) if token[2] else (token[4], token[5])
        if not name:
            continue
        tag, attributes = name.lower(), (token[3] if token[2] else token[6])
        if not end and tag in RAW and not attributes.endswith("/"):
            if tag in BLOCKS:
                close()
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, place)
            place = stop.end() if stop else len(page)
            continue
        if tag == "a":
            links = 0 if end else 1
        if tag in BLOCKS:
            close()
        if tag in VOID or attributes.endswith("/"):
            continue
        if aside is not None:
            if tag == within:
                deeper += -1 if end else 1
                within = within if deeper else ""
            elif sure == HINTED and not within and not end and _noted(tag, attributes, True) == SURE:
                within, deeper = tag, 1
            if tag == aside:
                depth += -1 if end else 1
                if depth == 0:
                    aside, links, sure, within = None, 0, NOT, ""
            elif tag in CONTAINERS and not end and not _noted(tag, attributes, False):
                aside, links, sure, within = None, 0, NOT, ""  # the element before was not closed
        elif not end and (sure := _noted(tag, attributes, containers > 0)):
            aside, depth = tag, 1
        if aside is None and tag in CONTAINERS:
            opened += not end and not containers
            containers = max(0, containers + (-1 if end else 1))
    add(page[place:])
    close()
    return lines


def main_text(page: str | None, rules: BlockRules = BlockRules()) -> str:
    """The lines between surges and dives, joined by line feeds.

    An article or main element with a surge is kept as a whole. The lines outside such elements
    are one sequence. Where all text stands in links, that in these elements is weighed.
    """
    lines = [line for line in lines_of(page or "") if line.text]
    _settle_hints(lines)
    weights = [0 if line.aside else line.plain for line in lines]
    if not any(weights):
        weights = [len(line.text) if line.container and not line.aside else 0 for line in lines]
    sequences: dict[int, list[int]] = {}
    for i, line in enumerate(lines):
        sequences.setdefault(line.container, []).append(i)
    sums = {
        container: _sums([weights[i] for i in places], rules.window)
        for container, places in sequences.items()
    }
    highest = max((x for found in sums.values() for x in found), default=0)
    limit = min(rules.surge, rules.share * highest)
    kept: list[int] = []
    for container, places in sequences.items():
        if container:
            if max(sums[container]) > limit:
                kept += places
            continue
        for first, last in _stretches([weights[i] for i in places], sums[container], limit):
            kept += places[first : last + 1]
    return "\n".join(lines[i].text for i in sorted(kept) if not lines[i].aside)


def _settle_hints(lines: list[_Line]) -> None:
    """A hint counts if what it speaks of is less than half of the text of its article."""
    held: dict[int, list[int]] = {}
    for line in lines:
        if line.container and line.aside != SURE:
            both = held.setdefault(line.container, [0, 0])
            both[line.aside == HINTED] += line.plain
    for line in lines:
        if line.aside == HINTED:
            plain, hinted = held[line.container]
            line.aside = SURE if hinted < plain else NOT


def _sums(weights: list[int], window: int) -> list[int]:
    return [sum(weights[i : i + window]) for i in range(len(weights))]


def _stretches(weights: list[int], sums: list[int], limit: float) -> Iterator[tuple[int, int]]:
    """The first and last lines between dives, where there is a surge between them."""
    for some, run in groupby(range(len(sums)), lambda i: sums[i] > 0):
        places = list(run)
        if some and max(sums[i] for i in places) > limit:
            weighty = [i for i in places if weights[i]]
            yield weighty[0], weighty[-1]


def extract(
    pages: DataFrame,
    rules: BlockRules = BlockRules(),
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars``, one row for each page.

    Null, empty and textless pages give an empty text. Repeated rows, null ids and null urls are
    passed on row by row; other columns are left out. Broken markup is read as far as it goes: an
    unclosed comment or script ends with the page, an unclosed menu where an article begins.
    """
    names = ["page_id", "url", "text", "n_chars"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page, rules) for page in batch.column(2).to_pylist()]
        sizes = pa.array(map(len, texts), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names
        )

    chosen = take(pages, page_id=id_column, url=url_column, html=html_column)
    return mapped(chosen, "html", "page_id bigint, url string, text string, n_chars bigint", run)
