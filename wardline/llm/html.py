"""Main text of web pages by the distribution of text over lines.

A page is stripped of its markup into lines, one per block element. The text lengths of the lines
are summed over a sliding window; where the sum surges above a threshold the article starts, where
it dives to nothing the article ends, and the lines in between are kept. Lines of navigation,
headers, footers, sidebars, notices, adverts, forms and comments weigh nothing; where only a name says that an
element is one of these, it still counts if it holds nearly all text. Where ``article`` or
``main`` hold half of a page's text or more, lines outside them weigh a quarter, and have to surge by
themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import pick, rows_of

WINDOW = 3
# Characters in a window that start an article, and the share of the fullest window that does too.
SURGE_CHARS = 86
SURGE_SHARE = 0.3
# Runs with less than this share of the longest run's text, and too little for a surge, are not part of the article.
RUN_SHARE = 0.25
# Share of the page's text that makes an element the preferred one, and the weight of lines outside it.
ELEMENT_SHARE, OUTSIDE_WEIGHT = 0.5, 0.25

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^a-z]+")

# Elements whose content is never text of the page.
_OPAQUE = set(
    "script style title noscript template svg math iframe object canvas textarea select button audio video datalist".split()
)
# Elements that never stand in a line of text.
_BLOCK = set(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre section summary table "
    "caption tbody tfoot thead tr ul".split()
)
_SPACE = set("br td th wbr".split()) - {"wbr"}
_OUTSIDE = set("nav footer aside form dialog menu".split())
_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
_NAMES = set(
    "nav navbar navigation menu masthead topbar footer sidebar aside widget ad ads adv advert adverts advertisement advertising "
    "adsense banner promo promotion sponsor sponsored notice notices cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup comment comments respond disqus discussion replies reply share sharing social "
    "related recommended recommendations breadcrumb breadcrumbs pagination pager login search searchbox copyright toolbar "
    "paywall disclaimer skip".split()
)
_COMMENTS = set("comment comments respond disqus discussion replies reply".split())
_HEADS = set("header head heading".split())
_BODY = set("article post entry content story main".split())
# A block element ends these without a closing tag.
_OPEN_ENDED = set("p li dd dt tr".split())


# How much of its page a marked element may hold before the mark does not count.
HARD, NAMED, COMMENTS = 1, 2, 3
# A named element with more than so many times the text outside all marked ones is the article, whatever its name.
NAMED_SHARE = 3


def _mark_of(tag: str, attributes: str, in_article: bool) -> int:
    """0, or how an element is marked as not part of the article: by its kind or role, by its name, as comments."""
    if tag in _OUTSIDE or tag == "header" and not in_article:
        return NAMED if tag == "form" else HARD
    if not attributes or tag in ("html", "body", "main"):
        return 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        parts = set(_PARTS.split("".join(values).lower()))
        if name.lower() == "role":
            if parts & _ROLES:
                return HARD
        elif tag == "article":
            if parts & {"comment", "comments", "reply", "replies"}:
                return COMMENTS
        elif parts & _NAMES or parts & _HEADS and not in_article and not parts & _BODY:
            return COMMENTS if parts & _COMMENTS else NAMED
    return 0


class _Region:
    """A marked element: its tag, how many of that name are open, the articles and mains around it, the regions around it."""

    def __init__(self, tag: str, mark: int, articles: int, mains: int, around: tuple):
        self.tag, self.mark, self.open, self.articles, self.mains = tag, mark, 1, articles, mains
        self.path = (*around, self)
        self.chars = 0


def marked_lines(page: str) -> list[tuple[str, int, int, tuple]]:
    """Lines in page order: text, characters in links, depth (0 body, 1 main, 2 article), marked elements around it."""
    lines: list[tuple[str, int, int, tuple]] = []
    pieces: list[str] = []
    regions: list[_Region] = []
    articles = mains = links = link_chars = 0
    at = 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join("".join(pieces).split())
        if text:
            lines.append((text, min(link_chars, len(text)), 2 if articles else 1 if mains else 0, regions[-1].path if regions else ()))
        pieces.clear()
        link_chars = 0

    def add(raw: str) -> None:
        nonlocal link_chars
        text = unescape(raw)
        pieces.append(text)
        if links:
            link_chars += len(text)

    def close(k: int) -> None:
        """The region ends, and with it what is open inside."""
        nonlocal articles, mains
        articles, mains = regions[k].articles, regions[k].mains
        del regions[k:]

    while mark := _MARK.search(page, at):
        if mark.start() > at:
            add(page[at : mark.start()])
        at = mark.end()
        tag = (mark[2] or mark[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(mark[1] or mark[4]), mark[3] or mark[6] or ""
        if tag in _OPAQUE:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                # an element without its end tag hides nothing but itself, unless it is code
                at = end.end() if end else len(page) if tag in ("script", "style") else at
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag in _SPACE:
            pieces.append(" ")
            continue
        if tag not in _BLOCK:
            continue
        flush()
        links = 0
        own = False  # the tag ends a region of its own name
        for k in reversed(range(len(regions))):
            region = regions[k]
            if region.tag in _OPEN_ENDED:
                if closing or tag == region.tag or tag in ("div", "article", "section", "main"):
                    own = own or closing and tag == region.tag
                    close(k)
            elif tag == region.tag:
                region.open += -1 if closing else 1
                if region.open <= 0:
                    own = True
                    close(k)
            elif tag in ("article", "main") and not closing and region.tag in ("nav", "header", "footer"):
                close(k)  # it was never closed
        if own:
            continue
        if closing:
            if tag == "article":
                articles = max(0, articles - 1)
            elif tag == "main":
                mains = max(0, mains - 1)
        elif kind := _mark_of(tag, attributes, articles > 0 or mains > 0):
            regions.append(_Region(tag, kind, articles, mains, regions[-1].path if regions else ()))
        elif tag == "article":
            articles += 1
        elif tag == "main":
            mains += 1
    if at < len(page):
        add(page[at:])
    flush()
    return lines


def page_lines(page: str) -> list[tuple[str, int, int]]:
    """Lines in page order: text, characters in links, depth (-1 outside the article, else 0 body, 1 main, 2 article).

    Elements marked by their kind (navigation, footers) are outside. A name is a hint: an element that is only named as
    something else is outside unless it holds nearly all text of the page, comments unless there is no other text. Text
    in ``article`` or ``main`` settles it: then names are believed.
    """
    lines = marked_lines(page)
    free, other, told = 0, 0, False
    for text, links, depth, around in lines:
        plain = len(text) - links if 2 * links < len(text) else 0
        if not around:
            free += plain
            told = told or depth > 0 and plain > 0
        if not any(r.mark in (HARD, COMMENTS) for r in around):
            other += plain
        if all(r.mark != HARD for r in around):
            for region in around:
                region.chars += plain

    def counts(region: _Region) -> bool:
        if region.mark == NAMED and not told:
            return region.chars > NAMED_SHARE * free
        return region.mark != HARD and not (other if region.mark == COMMENTS else free) and region.chars > 0

    return [(text, links, depth if all(map(counts, around)) else -1) for text, links, depth, around in lines]


def _runs(weight: list[float], block: list[float], surge: float, whole: bool, kept: list[bool]) -> list[list[int]]:
    """Lines from each surge to its dive: those with weight, and others that are ``kept`` between two of them.

    With ``whole`` also the lines with weight between the dive before and the surge.
    """
    runs: list[list[int]] = []
    inside, before, between = False, [], []
    for i, total in enumerate(block):
        if total == 0:
            inside, before, between = False, [], []
        elif not inside and total >= surge:
            inside = True
            runs.append(before if whole else [])
        if weight[i]:
            (runs[-1] if inside else before).extend([*between, i] if inside else [i])
            between = []
        elif inside and kept[i] and runs[-1]:
            between.append(i)
    return runs


def main_text(page: str | None, window: int = WINDOW) -> str:
    """Text between the surge and dive points of the line distribution; empty if there is none."""
    lines = page_lines(page) if page else []
    if not any(depth >= 0 for _, _, depth in lines):
        return ""
    # Lines that are mostly links do not count, but inside the preferred element every line counts whole.
    plain = [len(text) - links if depth >= 0 and 2 * links < len(text) else 0 for text, links, depth in lines]
    held = [sum(n for n, line in zip(plain, lines, strict=True) if line[2] >= depth) for depth in range(3)]
    most = max(depth for _, _, depth in lines)
    scope = max(depth for depth in range(most + 1) if held[depth] >= ELEMENT_SHARE * held[0])
    weights = [[len(t) if scope and depth >= scope else 0 if scope else n for n, (t, _, depth) in zip(plain, lines, strict=True)]]
    if scope:
        weights.append([OUTSIDE_WEIGHT * n if line[2] < scope else 0 for n, line in zip(plain, lines, strict=True)])
    blocks = [[sum(w[i : i + window]) for i in range(len(w))] for w in weights]
    surge = min(SURGE_CHARS, SURGE_SHARE * max(map(max, blocks)))
    # short lines before the surge, such as titles, belong to the preferred element's text
    kept = [line[2] == 0 for line in lines]  # a paragraph that is mostly one link stands between others
    runs = [(w, run) for k, w in enumerate(weights) for run in _runs(w, blocks[k], surge, scope > 0 and k == 0, kept if not scope else [False] * len(lines))]
    found = [(run, sum(w[i] for i in run)) for w, run in runs]
    least = min(SURGE_CHARS, RUN_SHARE * max((size for _, size in found), default=0))
    return "\n".join(lines[i][0] for i in sorted(i for run, size in found if size >= least for i in run))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, one row for each row.

    Null or empty html, and pages without text, give an empty text. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = pa.array([main_text(h) for h in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["page_id", "url", "text"])

    kept = pick(
        pages, page_id=F.col(page_id).cast("bigint"), url=F.col(url).cast("string"), html=F.col(html).cast("string")
    )
    found = kept.mapInArrow(run, "page_id bigint, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
