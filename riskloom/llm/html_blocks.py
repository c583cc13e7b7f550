"""Main text of raw pages by line-block distribution.

Markup is stripped to lines: block tags end a line, inline tags vanish, and a removed part (script,
menu, advert, form, reader comments, ...) leaves a gap of `WINDOW` empty lines.  The lengths of every
window of `WINDOW` lines are summed; a window that rises to the threshold is a surge point, the next
one that falls to nothing is a dive point, and the lines between them are a surging region.
A line counts its characters, or nothing if most of them are in links; a line inside <article> or
<main> counts `BONUS` more.  The threshold is `SURGE`, or the highest window of a page that has none
so high.

The innermost element that holds all surging regions is the article: its lines are kept, short ones and those behind
a removed part included, but for rows of `WINDOW` or more lines of links and links at either end.  On a page whose
regions share no element below its body, a region that does not surge is kept if no line of links parts it from a
kept one beside it, or if it lies in a row of such regions between two that surge.

A part is removed for its tag, for a class, id or role that is the name of such a part ("sidebar"), and for one that
contains such a name ("no-sidebar") only if it holds less than half of the text outside the others.

Defined results: missing, empty or markup-only html gives the empty text, text without any tag is kept; an element
left open ends with its page, but a removed part never runs over the begin of the article; a tag that is not closed
before the next one begins is text; rows are independent, so repeated rows repeat and an empty table gives an empty
one; other columns are kept.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80
BONUS = SURGE // 2        # what the mark of an article adds to a line, so that two lines in a window surge
QUOTED = 4_000            # characters of an attribute's value that are read as one
# Nothing here looks further than the next tag or the end of what it consumes, so reading is linear.
_REST = rf"(?:\"[^\"]{{0,{QUOTED}}}+\"|'[^']{{0,{QUOTED}}}+'|[^<>\"'])*+"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|object|canvas|title|math)\b{_REST}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<rest>{_REST})>"
    r"|<[!?][^<>]*+>",
    re.S | re.I)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
SPACES = frozenset("br td th option wbr img input".split())
# Elements that can hold an article; not the page's own, which hold everything.
HOLDERS = frozenset("article main section div td details dialog figure fieldset blockquote center".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
REMOVED = frozenset("nav footer aside form menu dialog button head".split())
# Names in class, id and role that mark parts around an article.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs share sharing social related recommended comment comments disqus replies "
    "newsletter subscribe subscription popup modal overlay footer masthead toolbar pagination pager login signup search complementary "
    "contentinfo dialog alert".split())


def _named(rest: str) -> str:
    """Whether class, id or role name a part to be removed: "strong" by a whole name, "weak" by a piece of one."""
    found = ""
    for mark in _MARKS.findall(rest):
        for name in mark.strip("\"'").lower().split():
            if name in MARKED:
                return "strong"
        if any(piece.lower() in MARKED for piece in _PARTS.findall(mark)):
            found = "weak"
    return found


def _shares(tags: list[re.Match], page: str) -> tuple[dict[int, int], int]:
    """Characters of text in each element with a weak name (by place of its tag), and in the page.

    What lies in parts that are removed for their tag or whole name counts nowhere.
    """
    shares: dict[int, int] = {}
    open_: dict[str, list[tuple[int, int, bool]]] = {}
    total = at = removed = 0
    for i, tag in enumerate(tags):
        total += 0 if removed else len(page[at:tag.start()].strip())
        at = tag.end()
        if tag["name"]:
            name = tag["name"].lower()
            if not tag["end"]:
                if name not in VOID:
                    named = _named(tag["rest"]) if tag["rest"] and name not in ("html", "body", "main") else ""
                    gone = name in REMOVED or named == "strong" and name != "article"
                    removed += gone
                    open_.setdefault(name, []).append((i if named == "weak" else -1, total, gone))
            elif open_.get(name):
                start, before, gone = open_[name].pop()
                removed -= gone
                shares[start] = total - before
    total += 0 if removed else len(page[at:].strip())
    for left in open_.values():
        shares.update((start, total - before) for start, before, _ in left)
    return shares, total


@dataclass
class Line:
    text: str
    linked: int = 0           # characters in links
    inside: bool = False      # of an article
    within: int = 0           # number of the innermost element around it, counted as they open; 0 is the page


def page_lines(page: str) -> tuple[list[Line], list[int], list[int]]:
    """The lines, and per element its parent and the number of elements opened when it closed."""
    tags = list(_TAG.finditer(page))
    shares, total = _shares(tags, page)
    lines: list[Line] = []
    parts: list[str] = []
    linked = at = in_article = 0
    in_link = marked = False
    skipping, depth = "", 0
    parent, closed = [0], [0]
    path: list[tuple[str, int]] = []           # open elements around the next line
    opened: Counter = Counter()

    def close(gap: int = 0) -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append(Line(text, linked, in_article > 0, path[-1][1] if path else 0))
        linked = 0
        lines.extend([Line("")] * gap)

    def leave(name: str) -> None:
        while opened[name]:
            own, number = path.pop()
            opened[own] -= 1
            closed[number] = len(parent)
            if own == name:
                break

    for i, tag in enumerate(tags):
        if not skipping and tag.start() > at:
            piece = page[at:tag.start()]
            parts.append(piece)
            linked += len(piece) if in_link else 0
        at = tag.end()
        if tag["name"] is None:
            continue
        name, ends = tag["name"].lower(), bool(tag["end"])
        article = name in ("article", "main")
        if skipping:
            first_article = article and not ends and not marked
            if not first_article:
                if name == skipping:
                    depth += -1 if ends else 1
                    if not depth:
                        skipping = ""
                continue
            skipping = ""
        if not ends and name not in VOID:
            removed = name in REMOVED or name == "header" and not in_article
            if not removed and tag["rest"] and name not in ("html", "body", "main"):
                named = _named(tag["rest"])
                # The first article is one whatever it is called; what a part holds decides where its name does not.
                removed = named == "strong" and (not article or marked) or named == "weak" and 2 * shares.get(i, 0) < total
            if removed:
                close(WINDOW)
                skipping, depth = name, 1
                continue
        if name == "a":
            in_link = not ends
        elif name in SPACES:
            parts.append(" ")
        elif name in BLOCKS:
            close()
            if article:
                marked = True
                in_article = max(0, in_article + (-1 if ends else 1))
            if name in HOLDERS:
                if ends:
                    leave(name)
                else:
                    parent.append(path[-1][1] if path else 0)
                    closed.append(0)
                    path.append((name, len(parent) - 1))
                    opened[name] += 1
    if not skipping:
        parts.append(page[at:])
    close()
    for _, number in path:
        closed[number] = len(parent)
    closed[0] = len(parent)
    return lines, parent, closed


def _length(line: Line) -> int:
    return (len(line.text) if 2 * line.linked <= len(line.text) else 0) + (BONUS if line.inside and line.text else 0)


def _common(lines: list[Line], parent: list[int], closed: list[int]) -> int:
    """Innermost element that holds all these lines."""
    holder = lines[0].within
    for line in lines:
        while not holder <= line.within < max(closed[holder], holder + 1):
            holder = parent[holder]
    return holder


def main_text(page: str | None) -> str:
    lines, parent, closed = page_lines(page or "")
    lengths = [_length(line) for line in lines]
    # Distribution over sliding windows: block i is lines i .. i + WINDOW - 1.
    block = [sum(lengths[i:i + WINDOW]) for i in range(len(lengths))]
    surge = min(SURGE, max(block, default=0))
    # Regions between dive points: first line, line after the last, whether it surges, whether links part it from the one before.
    regions: list[tuple[int, int, bool, bool]] = []
    i = end = 0
    while i < len(block):
        if not block[i]:
            i += 1
            continue
        dive = i
        while dive < len(block) and block[dive]:
            dive += 1
        at = [j for j in range(i, min(dive + WINDOW - 1, len(lines))) if lengths[j]]
        links = any(line.text for line in lines[end:at[0]])
        regions.append((at[0], at[-1] + 1, max(block[i:dive]) >= surge, links))
        i, end = dive + WINDOW - 1, at[-1] + 1
    surging = [line for first, last, surges, _ in regions if surges for line in lines[first:last] if line.text and _length(line)]
    holder = _common(surging, parent, closed) if surging else 0
    if holder:
        own = [line for line in lines if line.text and holder <= line.within < closed[holder]]
        kept = _without_menus(own)
    else:
        kept = [line for first, last in _kept(regions) for line in lines[first:last] if line.text]
    return "\n".join(line.text for line in kept)


def _without_menus(lines: list[Line]) -> list[Line]:
    """The lines of an article without rows of `WINDOW` or more lines of links, and without links at either end."""
    out: list[Line] = []
    row: list[Line] = []
    for line in lines:
        if not _length(line):
            row.append(line)
            continue
        if out and len(row) < WINDOW:
            out += row
        row = []
        out.append(line)
    return out


def _kept(regions: list[tuple[int, int, bool, bool]]) -> list[tuple[int, int]]:
    """Regions that surge, those beside one, and those between two, in each row of regions that no links part."""
    out: list[tuple[int, int]] = []
    row: list[tuple[int, int, bool, bool]] = []
    for region in [*regions, None]:
        if row and (region is None or region[3]):
            surging = [i for i, r in enumerate(row) if r[2]]
            if surging:
                out += [r[:2] for r in row[max(0, surging[0] - 1):surging[-1] + 2]]
            row = []
        row.append(region)
    return out


def _main_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([main_text(page) for page in batch], dtype=object)


def extract(pages: DataFrame, *, html: str = "html", text: str = "text") -> DataFrame:
    """`pages` with the main text of its raw html."""
    return pages.withColumn(text, F.pandas_udf(_main_texts, "string")(F.coalesce(F.col(html), F.lit(""))))
