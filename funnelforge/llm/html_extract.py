"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  The first pass decides blocks by
stop-word density, length and link density; blocks inside menus, headers,
footers, side bars, notices, adverts, forms and comments (by element, role,
class or id) are out.  Short blocks and blocks between the thresholds stay
ambiguous; in the second pass they take the label of their nearest decided
neighbours.  Inside ``article`` or ``main`` the rules lean towards text, outside
towards boilerplate.

Defined results: null, empty or text-free html gives an empty string; broken or
unclosed markup is read as far as it goes: only raw text (scripts, styles, text
areas, titles) runs to the page's end without its end tag, of any other skipped
element without one, or closed in itself, just the tag is skipped; a page of which no block is decided
keeps its undecided blocks; repeated pages count as given.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Function words of the languages handled (fixed values).
STOP_WORDS = frozenset("""
the of and to a in is it that for was on with as be by at this from or an are not have but which they you his her had
der die das und in zu den von mit ist des sich auf für ein eine im dem nicht als auch es an werden aus er hat dass
de la le les et des en un une du dans que pour qui sur au par pas est plus avec ce il sont se ne
el los las y del una por con para su lo como al o este sus pero más ha no es si
""".split())
#: Elements whose content is never text of the article (fixed values).
SKIPPED = frozenset("noscript template iframe object svg select button math canvas audio video".split())
#: Skipped elements without markup inside; ``<title/>`` and ``<style/>`` are those of drawings.
RAW_TEXT = r"script|textarea|(?:style|title)(?![^>]*/>)"
#: Elements that may close themselves.
FOREIGN = frozenset("svg math".split())
BAD_ELEMENTS = frozenset("nav header footer aside form dialog menu fieldset".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
BAD_NAMES = frozenset("""
ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice
notices popup modal overlay sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar social
share sharing related recommended recommendations newsletter subscribe subscription signup login comment comments disqus
discussion replies respond widget widgets toolbar pagination pager copyright disclaimer legal skip form search
""".split())
MAIN_ELEMENTS = frozenset("article main".split())
CONTAINERS = frozenset("""
html body div section article main nav header footer aside form dialog menu fieldset ul ol dl table details center
blockquote figure
""".split())
BLOCKS = CONTAINERS | frozenset("""
p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre address hr figcaption summary legend option optgroup
""".split())
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW_TEXT})(?![\w:-])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?+)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?+)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?", re.I)
_NAME = re.compile(r"[a-z0-9]+")
_QUALIFIERS = frozenset("has with no without is".split())
_EDGE = "\"'.,;:!?()[]{}«»“”‘’„…-–—|"
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.08, 0.14
LINKS = 0.5
GOOD, NEAR, UNSURE, BAD, OUT = "good", "near", "unsure", "bad", "out"


class _Block:
    __slots__ = ("parts", "linked", "out", "main", "heading", "text", "label")

    def __init__(self, out: bool, main: bool, heading: bool):
        self.parts, self.linked, self.out, self.main, self.heading = [], 0, out, main, heading
        self.text, self.label = "", UNSURE


def _is_out(name: str, attributes: str, in_main: bool) -> bool:
    if name in ("html", "body"):
        return False
    if name in BAD_ELEMENTS and not (in_main and name == "header"):
        return True
    if not attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key == "role" and BAD_ROLES.intersection(value.split()):
            return True
        if key in ("class", "id"):
            for part in value.split():
                names = _NAME.findall(part)
                if any(n in BAD_NAMES and not (i and names[i - 1] in _QUALIFIERS) for i, n in enumerate(names)):
                    return True
    return False


def _skipped_to(tags: list[re.Match]) -> dict[int, int]:
    """Start of each skipped element that has an end tag, and where it ends."""
    opened: dict[str, list[int]] = {}
    ends = {}
    for m in tags:
        if (name := (m[3] or m[6] or "").lower()) not in SKIPPED:
            continue
        if (m[2] or m[5]) == "/":
            if opened.get(name):
                ends[opened[name].pop()] = m.end()
        elif name not in FOREIGN or not (m[4] or m[7] or "").endswith("/"):
            opened.setdefault(name, []).append(m.start())
    return ends


def cut_blocks(page: str) -> list[_Block]:
    """The text blocks of a page in order, with their surroundings."""
    stack: list[tuple[str, bool, bool]] = []  # element, inside something out, inside main
    found: list[_Block] = []
    block, links, heading, at = None, 0, False, 0

    def text(piece: str) -> None:
        nonlocal block
        if not piece:
            return
        piece = html.unescape(piece) if "&" in piece else piece
        if block is None:
            _, out, main = stack[-1] if stack else ("", False, False)
            block = _Block(out, main, heading)
            found.append(block)
        block.parts.append(piece)
        if links:
            block.linked += len(piece.strip())

    tags = list(_TAG.finditer(page))
    ends = _skipped_to(tags)
    for m in tags:
        if m.start() < at:
            continue
        text(page[at:m.start()])
        at = ends.get(m.start(), m.end())
        if not (name := (m[3] or m[6] or "").lower()):
            continue
        closing = (m[2] or m[5]) == "/"
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
        elif name == "br":
            text(" ")
        elif name in BLOCKS:
            block, links = None, 0
            heading = not closing and name in ("h1", "h2", "h3", "h4", "h5", "h6")
            if name in CONTAINERS:
                if closing:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == name:
                            del stack[i:]
                            break
                elif not (m[4] or m[7] or "").endswith("/"):
                    _, out, main = stack[-1] if stack else ("", False, False)
                    if name in MAIN_ELEMENTS and out and all(not o or n == "form" for n, o, _ in stack):
                        out = False  # a form around the whole page
                    out = out or _is_out(name, m[4] or m[7] or "", main)
                    stack.append((name, out, main or name in MAIN_ELEMENTS))
            elif not closing and (m[4] or m[7]) and _is_out(name, m[4] or m[7], True):
                _, _, main = stack[-1] if stack else ("", False, False)
                block = _Block(True, main, heading)
                found.append(block)
    text(page[at:])
    for b in found:
        b.text = " ".join("".join(b.parts).split())
    return [b for b in found if b.text]


def _classify(block: _Block) -> str:
    n = len(block.text)
    if block.out:
        return OUT
    if block.linked > LINKS * n or not block.main and block.text[0] == "©":
        return BAD
    if n < SHORT:
        return BAD if block.linked and not block.main else UNSURE
    words = block.text.lower().split()
    density = sum(w.strip(_EDGE) in STOP_WORDS for w in words) / len(words)
    if density >= STOP_HIGH:
        return GOOD if n > LONG or block.main else NEAR
    return NEAR if density >= STOP_LOW or block.main else BAD


def main_text(page: str | None) -> str:
    """The article's text, blocks joined by one space."""
    found = cut_blocks(page or "")
    for b in found:
        b.label = _classify(b)
    # blocks that are out by their surroundings say nothing about the rest
    inner = [b for b in found if b.label != OUT]
    decided = [b.label if b.label in (GOOD, BAD) else None for b in inner]
    if not any(decided) and not any(b.main for b in inner):
        return " ".join(b.text for b in inner)
    before, last = [], None
    for d in decided:
        before.append(last)
        last = d or last
    after, last = [], None
    for d in reversed(decided):
        after.append(last)
        last = d or last
    after.reverse()
    kept = []
    for b, d, x, y in zip(inner, decided, before, after):
        if d is None:
            sides = [s for s in (x, y) if s]
            if b.main:
                good = not sides or GOOD in sides
            elif b.label == NEAR or b.heading and y == GOOD:
                good = GOOD in sides
            else:
                good = bool(sides) and BAD not in sides
            d = GOOD if good else BAD
        if d == GOOD:
            kept.append(b.text)
    return " ".join(kept)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, the main text and its number of code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint"))
