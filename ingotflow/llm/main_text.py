"""Main text of HTML pages by line-block distribution.

The markup is read once, tag by tag. Block-level tags and ``<br>`` end a line; other tags vanish without
a space. What is inside scripts, styles, forms, menus, headers, footers, asides, or inside an element
whose role, class or id names such a part (adverts, notices, comments, ...), belongs to no line; inside an
article the whole name must say so. A form or a so named element may also wrap the text itself: if a
page gives none otherwise, the one with the most text of its own (in an article, if any) is opened, with those around
it, and the page read again.

Each line has a length, the characters of its text outside links. If the page marks its text (``<main>``, or
``<article>`` on a page without), that is a weight: the lines inside count all characters ``INSIDE`` times, those
outside only by ``OUTSIDE``. The lengths are summed over sliding windows of ``WINDOW`` lines. Text begins at a
surge, a line of some length whose window's sum rises to ``LEAST`` (or to the highest sum, inside if the page
marks its text, if that is lower), and ends at the dive, where the sums fall to zero or the marked text ends; lines of some length just
before a surge belong to it, and between a dive and the next surge nothing is kept. On a marked page, text
outside is kept only if it outweighs all inside: then the marks are of something else.

Edge cases: a null or empty page, and a page without text, gives an empty text. Unclosed tags end with
the page; paragraphs, list items, terms, cells, rows and options also end where HTML implies it, at any depth. A quote
that closes nothing ends with its tag, and so does a tag that meets another one or the page's end. Hidden parts
and ``<noscript>`` are text like any other. Very long pages are read whole, in one pass. Rows
are mapped one by one, so repeated rows and ids, null ids and urls and further columns change nothing.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.common import map_slices

WINDOW, LEAST = 3, 80
#: Weights of lines inside and outside a page's marked text.
INSIDE, OUTSIDE = 4, 1 / 8

# a quoted value only begins behind an equals sign; what is read is not given back, so time is linear
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|textarea|svg|iframe)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
                 r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^<>])*+)(?:>|(?=<)|\Z)"
                 r"|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no main text.
CLUTTER = frozenset("head title nav header footer aside form menu button select dialog".split())
#: First parts of names like ``has-sidebar`` and ``no-comments``, which are of other elements than they name.
ABOUT = frozenset("has have with without no not is hide show".split())
#: Elements that mark a page's text.
ARTICLE = frozenset(["article", "main"])
#: Words in a class, id or role that mark clutter.
CLUTTER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments contentinfo "
    "cookie cookies consent disqus footer gdpr header masthead menu nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted related replies respond search share sharing sidebar social sponsor sponsored "
    "subscribe subscription toolbar widget".split())
#: Words that add nothing to what a clutter word names, as in ``related-posts``.
PLAIN_WORDS = frozenset(
    "area bar block box button buttons container content group icons inner items link links list outer panel post "
    "posts row section site slot text title top bottom left right unit wrap wrapper".split())
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_PART = re.compile(r"[a-z]+", re.I)
SPACE = re.compile(r"\s+")
#: Elements that end by themselves: which tags end them, and inside which elements that has no effect.
IMPLIED_ENDS = [
    (BLOCKS - {"br"}, ("p",), ("button", "table", "td", "th", "caption")),
    ({"li"}, ("li",), ("ul", "ol", "menu", "dir")),
    ({"dt", "dd"}, ("dt", "dd"), ("dl",)),
    ({"td", "th", "tr", "tbody", "thead", "tfoot"}, ("td", "th"), ("table",)),
    ({"tr", "tbody", "thead", "tfoot"}, ("tr",), ("table",)),
    ({"option", "optgroup"}, ("option",), ("select", "datalist")),
]
ENDS = {tag: [(ended, scopes) for tags, ended, scopes in IMPLIED_ENDS if tag in tags]
        for tags, _, _ in IMPLIED_ENDS for tag in tags}


def is_named_clutter(attributes: str, in_article: bool) -> bool:
    for found in NAMED.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").split():
            parts = NAME_PART.findall(name.lower())
            if parts and parts[0] not in ABOUT and not CLUTTER_WORDS.isdisjoint(parts) and not (
                    in_article and set(parts) - CLUTTER_WORDS - PLAIN_WORDS):
                return True
    return False


def clutter_kind(tag: str, attributes: str, in_article: bool) -> str | None:
    """``wrapper`` if the clutter may wrap the page's text, else ``part``."""
    if tag in CLUTTER:
        return "wrapper" if tag == "form" else None if tag == "header" and in_article else "part"
    if tag in ("body", "html", "article", "main") or not attributes:
        return None
    return "wrapper" if is_named_clutter(attributes, in_article) else None


@dataclass
class Wrapper:
    """A clutter element that may be opened, and the characters of its own text."""

    form: bool
    around: int | None
    in_article: int = 0
    outside_links: int = 0


@dataclass
class Line:
    text: str
    outside_links: int
    in_main: bool
    in_article: bool


def lines_of(html: str, opened: frozenset[int] = frozenset()) -> tuple[list[Line], list[Wrapper]]:
    """The lines and the wrappers of the page. Wrappers in ``opened`` are no clutter."""
    lines: list[Line] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[str] = []
    depths: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of each tag
    wrappers: list[Wrapper] = []
    inside: list[tuple[int, int]] = []  # depth and number of each wrapper that is open and clutter
    around: list[tuple[int, int]] = []  # of each wrapper that is open
    # depth of the element that began it: clutter, marked text, marked text inside a wrapper, a link
    at_depth: dict[str, int | None] = dict.fromkeys(("part", "main", "article", "wrapped", "link"))

    def end_line() -> None:
        if parts:
            text = SPACE.sub(" ", references.unescape("".join(parts))).strip()
            if text:
                links = len(SPACE.sub(" ", references.unescape("".join(linked))).strip())
                lines.append(Line(text, max(len(text) - links, 0), at_depth["main"] is not None,
                                  at_depth["article"] is not None))
            parts.clear()
            linked.clear()

    def close_to(depth: int) -> None:
        for tag in stack[depth:]:
            depths[tag].pop()
        del stack[depth:]
        for what, began in at_depth.items():
            if began is not None and began >= depth:
                at_depth[what] = None
        for some in (inside, around):
            while some and some[-1][0] >= depth:
                some.pop()

    def last(tags: tuple[str, ...]) -> int:
        return max((depths[t][-1] for t in tags if depths[t]), default=-1)

    def take(text: str) -> None:
        if at_depth["part"] is not None:
            return
        if inside:
            own = wrappers[inside[-1][1]]
            size = len(text.strip())
            own.in_article += size if at_depth["wrapped"] is not None else 0
            own.outside_links += size if at_depth["link"] is None else 0
            return
        parts.append(text)
        if at_depth["link"] is not None:
            linked.append(text)

    at = 0
    for found in TAG.finditer(html):
        if found.start() > at:
            take(html[at:found.start()])
        at = found.end()
        if not found[3]:
            continue
        tag = found[3].lower()
        if tag in BLOCKS:
            end_line()
        if found[2]:
            if depths[tag]:
                close_to(depths[tag][-1])
        elif tag not in VOID and not found[4].endswith("/"):
            for ended, scopes in ENDS.get(tag, ()):
                if (depth := last(ended)) > last(scopes):
                    close_to(depth)
            depth = len(stack)
            stack.append(tag)
            depths[tag].append(depth)
            marked = any(at_depth[what] is not None for what in ("main", "article", "wrapped"))
            kind = None if at_depth["part"] is not None else clutter_kind(tag, found[4], marked)
            if kind == "part":
                at_depth["part"] = depth
            elif kind:
                number = len(wrappers)
                wrappers.append(Wrapper(tag == "form", around[-1][1] if around else None))
                around.append((depth, number))
                if number not in opened:
                    inside.append((depth, number))
            if tag in ARTICLE and at_depth["part"] is None:
                what = "wrapped" if inside else tag
                if at_depth[what] is None:
                    at_depth[what] = depth
            if tag == "a" and at_depth["link"] is None:
                at_depth["link"] = depth
    if at < len(html):
        take(html[at:])
    end_line()
    return lines, wrappers


def marks_of(lines: list[Line]) -> list[bool]:
    """Whether each line is inside the page's marked text: ``<main>`` if there is any, else ``<article>``."""
    if any(line.in_main for line in lines):
        return [line.in_main for line in lines]
    return [line.in_article for line in lines]


def wrappers_of_text(lines: list[Line], wrappers: list[Wrapper]) -> frozenset[int]:
    """The wrapper that holds the page's text, with those around it; none if the text lies outside."""
    if not wrappers or any(marks_of(lines)):
        return frozenset()
    best = max(range(len(wrappers)), key=lambda k: (wrappers[k].in_article, wrappers[k].outside_links))
    if not wrappers[best].in_article:
        kept = sum(line.outside_links for line in lines)
        best = max(range(len(wrappers)), key=lambda k: wrappers[k].outside_links)
        form = max((k for k in range(len(wrappers)) if wrappers[k].form), default=None,
                   key=lambda k: wrappers[k].outside_links)
        if kept >= LEAST:
            best = form if form is not None and wrappers[form].outside_links > kept else None
        if best is None or wrappers[best].outside_links < LEAST:
            return frozenset()
    opened = set()
    at: int | None = best
    while at is not None:
        opened.add(at)
        at = wrappers[at].around
    return frozenset(opened)


def text_lines(lengths: list[float], marks: list[bool]) -> list[int]:
    """The lines from each surge to its dive."""
    n, any_marked = len(lengths), any(marks)
    sums = [sum(lengths[i:i + WINDOW]) for i in range(n)]
    threshold = min(LEAST, max((s for s, mark in zip(sums, marks) if mark or not any_marked), default=0))
    kept: list[int] = []
    i = 0
    while i < n:
        if not lengths[i] or sums[i] < threshold:
            i += 1
            continue
        begin = i  # a surge
        while begin and lengths[begin - 1] and marks[begin - 1] == marks[i] and begin - 1 > (kept[-1] if kept else -1):
            begin -= 1
        dive = next((j for j in range(i, n) if not sums[j] or marks[j] != marks[i]), n)
        kept += range(begin, dive)
        i = dive
    return kept


def extract(html: str | None) -> str:
    """The main text of one page."""
    lines, wrappers = lines_of(html or "")
    if opened := wrappers_of_text(lines, wrappers):
        lines, _ = lines_of(html or "", opened)
    marks = marks_of(lines)
    marked = any(marks)
    lengths = [INSIDE * len(line.text) if mark else line.outside_links * (OUTSIDE if marked else 1)
               for line, mark in zip(lines, marks)]
    kept = text_lines(lengths, marks)
    if marked and sum(lengths[i] for i in kept if not marks[i]) <= sum(lengths[i] for i in kept if marks[i]):
        kept = [i for i in kept if marks[i]]
    return " ".join(lines[i].text for i in kept)


def extract_pages(df: DataFrame, html: str = "html", keep: tuple[str | Column, ...] = ("page_id", "url")
                  ) -> DataFrame:
    """The columns of ``keep``, ``text`` and ``n_chars`` (its code points) of every row."""
    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(page) for page in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            [*batch.schema.names[1:], "text", "n_chars"])

    rows = df.select(F.col(html).alias("_html"), *keep)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[1:])
    return map_slices(rows, apply, 0, f"{kept}text string, n_chars long")
