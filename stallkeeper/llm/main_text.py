"""Main text of a page by the distribution of text over its lines.

Markup is stripped to lines, one for every block of the page; block boundaries without text leave
empty lines. The text lengths of ``WINDOW`` successive lines are summed. Where a sum rises from
nothing a run of text begins, where it falls back to nothing the run ends; a run counts as main
text if its sums surge to ``SURGE`` characters, or if it has the highest sum of the page. Menus,
headers, footers, side bars, notices, adverts, forms, scripts, styles and reader comments are
known by their elements, roles, and names and leave a gap as wide as a window, so that a run never
reaches across them. They end where their element does, if need be with an element around them; one
that holds the only article, or most of the text, is a wrapper and stays. Text in links does not
count towards a surge.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from stallkeeper.llm.common import map_batches, values

WINDOW = 3
SURGE = 80

# HTML elements by their part in a page.
RAW = "script|style|noscript|template|iframe|svg|math|object|canvas|select|textarea|title"
SKIPPED = frozenset(
    "head nav header footer aside form menu dialog button fieldset audio video".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
# Whole names, or all parts of a name with hyphens but for those that say where or of what kind.
NAME = re.compile(
    r"(?:ad|ads|advert\w*|adsense|banner|breadcrumbs?|comments?|commentlist|cookies?|"
    r"consent|disqus|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|"
    r"notification|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|social|"
    r"sponsor\w*|subscribe|toolbar|widget)",
    re.I,
)
PLACE = re.compile(
    r"(?:area|articles|bar|block|bottom|box|buttons?|container|form|global|header|icons?|inner|item|"
    r"items|left|links?|list|main|media|mobile|page|posts|primary|right|secondary|section|site|slot|"
    r"top|wrap|wrapper|\d*)",
    re.I,
)
REPLIES = re.compile(r"(?:comments?|commentlist|disqus|replies|respond)", re.I)
MAIN = ("article", "main")
# Elements that a start tag ends, and those it does not look beyond.
_ROWS = frozenset(["table"])
_ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "td": (frozenset("td th".split()), _ROWS),
    "th": (frozenset("td th".split()), _ROWS),
    "tr": (frozenset("tr td th".split()), _ROWS),
    "tbody": (frozenset("thead tbody tfoot tr td th".split()), _ROWS),
    "tfoot": (frozenset("thead tbody tfoot tr td th".split()), _ROWS),
    "option": (frozenset(["option"]), frozenset()),
    "body": (frozenset(["head"]), frozenset()),
}
_CELLS = frozenset("td th caption button object".split())
_PIECE = re.compile(
    r"<!--.*?(?:-->|$)"
    rf"|<(?P<raw>{RAW})\b[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|$))"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<more>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*)(?P<more2>[^>]*)>"
    r"|<[a-z/][^<>]*$",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)


def _named(token: str) -> bool:
    parts = re.split(r"[_-]+", token)
    return any(map(NAME.fullmatch, parts)) and all(
        NAME.fullmatch(part) or PLACE.fullmatch(part) for part in parts
    )


def _unwanted(name: str, more: str) -> str:
    """Why an element is unwanted: its name, role, or the one of its names that says so."""
    if name in SKIPPED:
        return name
    if "=" not in more or name in ("html", "body", *MAIN):
        return ""
    for key, *found in _ATTRIBUTE.findall(more):
        value = "".join(found)
        if key.lower() == "role":
            if value.lower() in ROLES:
                return value
        else:
            for token in value.split():
                if _named(token):
                    return token
    return ""


def _ends(tags: list[tuple]) -> dict[int, int]:
    """By start tag, the tag at which its element ends; those that nothing ends are left out."""
    ends, stack = {}, []
    opened = Counter()

    def close(upto: int, at: int) -> None:
        while len(stack) > upto:
            name, i = stack.pop()
            opened[name] -= 1
            ends[i] = at

    for i, (_, _, name, closing, m) in enumerate(tags):
        if not name or name in VOID or (m["more"] or m["more2"] or "").endswith("/"):
            continue
        if closing:
            if opened[name]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        close(k, i)
                        break
                    if name not in BLOCKS and name not in ("body", "html") and stack[k][0] in BLOCKS:
                        break  # an inline element does not end the blocks inside it
            continue
        if name in BLOCKS and opened["p"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k, i)
                if k >= len(stack) or stack[k][0] in BLOCKS:
                    break
        if name in _ENDS:
            ended, limits = _ENDS[name]
            if any(opened[n] for n in ended):
                lowest = None
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in limits:
                        break
                    if stack[k][0] in ended:
                        lowest = k
                        if name not in ("tr", "tbody", "tfoot"):
                            break
                if lowest is not None:
                    close(lowest, i)
        stack.append((name, i))
        opened[name] += 1
    return ends


def _unlinked(source: str, tags: list[tuple]) -> list[int]:
    """Characters of text outside links before each tag, and in all."""
    before, linked, at, size = [], False, 0, 0
    for start, end, name, closing, _ in tags:
        if not linked and start > at:
            size += len("".join(source[at:start].split()))
        before.append(size)
        at = end
        if name == "a":
            linked = not closing
        elif name in BLOCKS and not closing:
            linked = False
    return [*before, size + (0 if linked else len("".join(source[at:].split())))]


def _skips(source: str, tags: list[tuple]) -> dict[int, int]:
    """By start tag of each unwanted element, the tag at which it ends, or its own if none does."""
    ends = _ends(tags)
    before = None
    skips, inside, last = {}, [], len(tags)
    marks = [i for i, t in enumerate(tags) if t[2] in MAIN and not t[3]]
    for i, (_, _, name, closing, m) in enumerate(tags):
        if not name or closing or name in VOID:
            continue
        while inside and inside[-1][1] <= i:
            inside.pop()
        end = ends.get(i, last)
        if name in MAIN:
            inside.append((i, end))
            continue
        more = m["more"] or m["more2"] or ""
        why = "" if more.endswith("/") else _unwanted(name, more)
        if not why:
            continue
        if i not in ends:
            skips[i] = i
            continue
        # Against the article around it, or else the page.
        outer, outer_end = inside[-1] if inside else (-1, last)
        around = bisect_left(marks, outer_end) - bisect_right(marks, outer)
        own = bisect_left(marks, end) - bisect_right(marks, i)
        if around:
            keeps = own == around
        else:
            before = before or _unlinked(source, tags)
            whole = before[outer_end] - before[max(outer, 0)]
            keeps = 2 * (before[end] - before[i]) > whole
            keeps = keeps and not any(map(REPLIES.fullmatch, re.split(r"[_-]+", why)))
        if name == "head" or not keeps:
            skips[i] = end
    return skips


def page_lines(source: str) -> tuple[list[str], list[int], list[bool]]:
    """The lines of a page and, for each, the characters outside links, and if in an article."""
    tags = []
    for m in _PIECE.finditer(source):
        name = (m["name"] or m["name2"] or "").lower()
        tags.append((m.start(), m.end(), name, bool(m["end"] or m["end2"]), m))
    skips = _skips(source, tags)
    lines, lengths, articles, text, linked = [], [], [], [], 0
    inside_link = False
    skip_end, article = -1, 0
    boundary = ""  # the tag before, if one of a block and no text since

    def add(line: str, length: int) -> None:
        lines.append(line)
        lengths.append(length)
        articles.append(article > 0)

    def end_line(kind: str, empty: int = 0) -> None:
        nonlocal linked, boundary
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            add(line, max(0, len(line) - linked))
        # Nested boundaries are one empty line, an element without text is one more.
        elif (kind == "end" and boundary == "start") or (boundary and (not lines or lines[-1])):
            add("", 0)
        for _ in range(empty):
            add("", 0)
        boundary = kind
        text.clear()
        linked = 0

    at = 0
    for i, (start, end, name, closing, m) in enumerate(tags):
        if i > skip_end and start > at:
            text.append(source[at:start])
            if inside_link:
                linked += start - at
        at = end
        if i < skip_end:
            continue
        if i == skip_end:
            if closing:  # by its own end tag, or by that of an element around it
                skip_end = -1
                inside_link = False
                if name in MAIN:
                    end_line("end", WINDOW)
                    article = max(0, article - 1)
                continue
            skip_end = -1  # by the start of the next
        if not name:
            if m["raw"]:
                text.append(" ")
            continue
        if closing:
            if name == "a":
                inside_link = False
            elif name in MAIN:
                end_line("end", WINDOW)
                article = max(0, article - 1)
            elif name in BLOCKS:
                end_line("end")
            continue
        more = m["more"] or m["more2"] or ""
        if name in VOID or more.endswith("/"):
            if name == "br" or name == "hr":
                text.append(" ")
        elif i in skips:
            end_line("start", WINDOW)
            skip_end = skips[i] if skips[i] > i else -1
        elif name == "a":
            inside_link = True
        elif name in MAIN:
            inside_link = False
            end_line("start", WINDOW)
            article += 1
        elif name in BLOCKS:
            inside_link = False
            end_line("start")
    if skip_end < 0:
        text.append(source[at:])
    end_line("end")
    return lines, lengths, articles


def main_text(source: str | None) -> str:
    """The main text: blocks in page order, joined by an empty line; empty where there is none."""
    if not source:
        return ""
    lines, lengths, articles = page_lines(source)
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lines))]
    filled = [any(lines[i : i + WINDOW]) for i in range(len(lines))]
    runs, start = [], None  # from the surge out of nothing to the dive back to it
    for i, full in enumerate([*filled, False]):
        if full and start is None:
            start = i
        elif not full and start is not None:
            runs.append((max(sums[start:i]), start, i))
            start = None
    if not runs:
        return ""
    highest = max(peak for peak, _, _ in runs)
    # In an article, or between others that are kept, a short run is part of the text.
    whole = [
        peak >= SURGE or peak == highest or any(f and x for f, x in zip(articles[a:b], lines[a:b]))
        for peak, a, b in runs
    ]
    first, last = whole.index(True), len(whole) - whole[::-1].index(True)
    kept = [line for _, a, b in runs[first:last] for line in lines[a:b] if line]
    return "\n\n".join(kept)


def extract_main_text(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per page: the ``keys`` columns, ``text`` and its length ``n_chars``.

    A null or empty page has the empty text. Repeated pages give repeated rows. Other columns are
    not read.
    """
    narrow = pages.select(*(f"`{k}`" for k in keys), f"`{html}`")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[:-1])
    schema += ", text string, n_chars long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = [main_text(source) for source in values(batch, html)]
            found = {k: batch.column(i) for i, k in enumerate(keys)}
            yield found | {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(narrow, run, schema.lstrip(", "))
