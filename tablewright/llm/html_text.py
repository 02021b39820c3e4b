"""Main text of web pages: flat text blocks, judged by a decision tree.

A page is cut into a flat list of text blocks at every block-level tag; inline tags and `br` do not cut.
Each block is described by its word count and link density, the same of its two neighbours, whether
it is a heading, and its zone: inside an element that holds articles (2), inside one that holds something
else - a menu, header, footer, sidebar, notice, advert, form or reader comments, by tag, role, class
or id - (0), or neither (1).  A small decision tree, trained on `LABELLED`, says which blocks belong to the
main text.  Nothing else is dropped or shortened.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and
joined by a line break in page order.  Scripts, styles, comments in the markup, the head and other
elements without prose are no blocks; of those, only what holds raw text runs to the end of the page when it
is not closed, and the others then drop nothing.  The text of formulas stays.  Unclosed and stray tags do not stop the search: an end tag closes
up to its start tag if there is one.

Null and empty pages give an empty text.  Repeated rows are extracted each; an empty table gives an empty
result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_stage
from .words import slices

# Elements and names of HTML.
CONTENT_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("nav header footer aside form dialog menu".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
# what an end tag may be missing of, or what holds text itself: their own class counts up to the next block
LEAF_TAGS = frozenset("p li dt dd td th tr tbody thead tfoot caption h1 h2 h3 h4 h5 h6 hr legend summary figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
OTHER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs header footer masthead cookie cookies consent gdpr notice notices alert banner popup modal "
    "overlay newsletter subscribe subscription signup share sharing social related recommended recommendations "
    "comment comments commentlist reply replies respond disqus discussion widget pagination pager toolbar copyright login search".split()
)
# what a section of an article may be about as well
TOPICS = frozenset(
    "adverts advertising promotion menu navigation header footer cookie cookies consent gdpr notice notices alert alerts banner "
    "share sharing social related discussion login search copyright subscription newsletter".split()
)
CONTENT_NAMES = frozenset("article content main post entry story body articlebody maincontent".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|iframe)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
# elements without prose: they go up to their own end tag, and stay where there is none
_BARE_TAGS = frozenset("noscript template select button svg object canvas audio video".split())
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+")
_UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# A labelled table of blocks: words, link density, both of the block before, both of the one after, zone, heading; main text?
LABELLED = """
 60 0.00  55 0.00  70 0.00 2 0 1
  3 0.00  40 0.00  52 0.00 2 0 1
  1 0.00   2 0.00  30 0.00 2 0 1
  8 0.00  12 1.00  90 0.00 2 1 1
 45 0.05   8 0.00  33 0.10 2 0 1
  5 1.00  61 0.00  48 0.00 2 0 1
 12 0.40  20 0.00   9 0.00 2 0 1
  2 0.00   7 0.00   4 0.00 2 1 1
120 0.00   0 0.00   0 0.00 2 0 1
  1 0.00   0 0.00   6 0.20 2 0 1
 25 0.60  25 0.00  30 0.00 2 0 1
  1 1.00   1 1.00   1 1.00 0 0 0
  2 1.00   1 1.00   8 0.00 0 0 0
 10 0.00   1 1.00  60 0.00 0 0 0
 40 0.00  60 0.00   0 0.00 0 0 0
 75 0.00  30 0.00  20 0.00 0 0 0
  6 0.30  50 0.00   0 0.00 0 0 0
  9 0.00   2 1.00  80 0.00 0 1 0
 18 0.10  90 0.00   5 0.00 0 0 0
150 0.00  12 0.00  40 0.00 0 0 0
  3 0.00   0 0.00   1 1.00 0 0 0
 50 0.00  45 0.00  60 0.00 1 0 1
 22 0.00  48 0.00  35 0.00 1 0 1
 80 0.05   6 0.00  40 0.00 1 0 1
  7 0.00   1 1.00  66 0.00 1 1 1
  6 0.00  70 0.00  58 0.00 1 1 1
  4 0.00  44 0.00  52 0.00 1 0 1
  9 0.00  64 0.00  31 0.00 1 0 1
  2 0.00  37 0.00  41 0.00 1 0 1
 30 0.20  25 0.00  28 0.00 1 0 1
  1 1.00   1 1.00   2 1.00 1 0 0
  2 1.00   0 0.00   1 1.00 1 0 0
  3 1.00  40 0.00   2 1.00 1 0 0
  5 0.80   3 1.00   4 1.00 1 0 0
 12 0.90   8 1.00  10 1.00 1 0 0
 20 0.75  12 0.90  15 0.80 1 0 0
  3 0.00   2 1.00   1 1.00 1 0 0
  4 0.00   1 1.00   2 1.00 1 1 0
  6 0.00   3 1.00   0 0.00 1 0 0
  5 0.00  50 0.00   1 1.00 1 0 0
  8 0.25   2 1.00   3 0.00 1 0 0
  4 1.00   3 1.00  60 0.00 1 0 0
  2 1.00   1 1.00  85 0.00 1 0 0
  6 0.90  70 0.00  64 0.00 1 0 0
  9 1.00  55 0.00   4 1.00 1 0 0
 60 0.00  50 0.00   1 1.00 1 0 1
 42 0.00  38 0.05   3 1.00 1 0 1
 35 0.00   0 0.00   0 0.00 1 0 1
 28 0.10   2 1.00   4 1.00 1 0 1
 95 0.00  70 0.00  12 0.00 0 0 0
 64 0.00   1 1.00  80 0.00 0 0 0
 33 0.00   9 0.00  45 0.00 0 0 0
  7 0.00  90 0.00  77 0.00 0 1 0
 14 0.00  35 0.00  66 0.00 0 0 0
  1 1.00  70 0.00  95 0.00 0 0 0
  5 0.00   0 0.00   0 0.00 1 0 1
  1 0.00   0 0.00   3 0.00 1 1 1
  3 0.00   1 0.00   3 0.00 1 0 1
  3 0.00   3 0.00   0 0.00 1 0 1
  8 0.00   5 0.00   0 0.00 1 0 1
 11 0.00   7 0.00   9 0.00 1 0 1
  6 0.00   4 0.00   0 0.00 1 0 1
  4 0.00   1 0.00   3 0.00 2 0 1
 17 0.00   5 0.00  11 0.00 2 0 1
  6 1.00   4 1.00   5 1.00 2 0 1
 10 0.00   2 0.00   1 1.00 2 0 1
  1 0.00   1 1.00   1 0.00 2 0 1
  1 0.00   1 1.00   2 1.00 2 0 1
  2 0.00   5 1.00   3 1.00 2 0 1
  3 0.00  12 0.90   1 1.00 2 1 1
  5 0.00   2 1.00   1 1.00 2 0 1
  4 0.50   3 1.00   6 1.00 2 0 1
  6 0.00  30 0.00   3 1.00 2 0 1
  5 0.00  12 0.00   4 1.00 2 0 1
  7 0.00  50 0.00   5 1.00 2 0 1
  5 0.00  50 0.00   1 1.00 2 0 1
  4 0.00  66 0.00   3 1.00 2 0 1
  3 0.00  80 0.00   1 1.00 2 0 1
 34 0.00  18 0.00  62 0.00 2 0 1
  6 0.00  51 0.00  16 0.00 2 0 1
 16 0.00  22 0.00  71 0.00 2 0 1
 25 0.00  23 0.00   9 0.00 2 0 1
 11 0.00   7 0.00  37 0.00 2 1 1
  3 0.00  25 0.00  16 0.00 2 0 1
  7 0.00   1 1.00   2 0.00 0 0 0
  1 1.00   1 1.00   8 0.00 0 0 0
 12 0.00   1 1.00   3 0.00 0 0 0
 11 0.00   5 0.00   0 0.00 0 0 0
 15 0.00  64 0.00   0 0.00 0 0 0
  9 0.00   9 0.00   0 0.00 0 0 0
"""
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "zone", "heading")
DEPTH = 6


class Block(NamedTuple):
    text: str
    words: int
    links: float
    zone: int
    heading: bool


def zone_of(tag: str, attributes: str, inside: int = 1) -> int | None:
    """2, 0, or None if the element says nothing.

    Inside an article, the class or id of a paragraph, heading or other leaf names what it is about, and the id
    of a section may.
    """
    if tag in CONTENT_TAGS:
        return 2
    if tag in OTHER_TAGS:
        return 0
    if tag in ("html", "body") or not attributes:
        return None
    found = None
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "").lower()
        if name == "hidden" or name == "style" and _UNSHOWN.search(value):
            return 0
        if name == "role":
            if value in OTHER_ROLES:
                return 0
            found = 2 if value in ("main", "article") else found
        elif name in ("class", "id"):
            if inside == 2 and tag in LEAF_TAGS:
                continue
            others = OTHER_NAMES - TOPICS if inside == 2 and tag == "section" and name == "id" else OTHER_NAMES
            for word in value.split():
                parts = _NAME.findall(word)
                if parts and parts[0] not in ("has", "with", "no", "without") and others.intersection(parts):
                    return 0
                if CONTENT_NAMES.intersection(parts):
                    found = 2
    return found


def bare_elements(page: str) -> dict[int, int]:
    """Start and end of the elements of `_BARE_TAGS` that are closed; nested ones are paired from the inside."""
    open_: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for m in _TOKEN.finditer(page):
        tag = (m[3] or m[6] or "").lower()
        if tag not in _BARE_TAGS:
            continue
        if not (m[2] or m[5]):
            if tag != "svg" or not (m[4] or m[7] or "").endswith("/"):
                open_.setdefault(tag, []).append(m.start())
        elif open_.get(tag):
            ends[open_[tag].pop()] = m.end()
    return ends


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []  # open container, zone inside, was that said by a tag
    opened: Counter[str] = Counter()  # containers of the stack
    parts: list[str] = []
    linked: list[str] = []
    in_link = False
    leaf: tuple[int | None, bool] = (None, False)  # zone and heading of the leaf element that is open
    zone, by_tag = 1, False

    def close() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            n = len(text.split(" "))
            within = len("".join(linked).split())
            own, heading = leaf
            out.append(Block(text, n, min(1.0, within / n), zone if own is None or zone == 0 else own, heading))
        parts, linked = [], []

    done = 0
    ends: dict[int, int] | None = None  # looked for once such an element turns up
    for m in _TOKEN.finditer(page):
        if m.start() < done:  # inside an element without prose
            continue
        if m.start() > done:
            text = html.unescape(page[done : m.start()])
            parts.append(text)
            if in_link:
                linked.append(text)
        done = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[1]:  # an element without prose stands between words
                parts.append(" ")
            continue
        if tag in _BARE_TAGS:
            ends = bare_elements(page) if ends is None else ends
            parts.append(" ")
            done = ends.get(m.start(), done)
            continue
        closing, attributes = bool(m[2] or m[5]), m[4] or m[7] or ""
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            parts.append(" ")
        elif tag == "head":
            # everything up to the body is no text
            close() if not closing else parts.clear()
        elif tag in BLOCK_TAGS:
            close()
            in_link = False
            leaf = (None, False)
            if tag in LEAF_TAGS:
                if not closing:
                    leaf = (zone_of(tag, attributes, zone), tag in HEADINGS)
            elif closing:
                while opened[tag]:  # a stray end tag closes nothing and looks at nothing
                    inner_tag = stack.pop()[0]
                    opened[inner_tag] -= 1
                    if inner_tag == tag:
                        break
            elif not attributes.endswith("/"):
                said = zone_of(tag, attributes, zone)
                inner, firm = zone, by_tag
                if said == 2 and not (zone == 0 and by_tag):
                    inner, firm = 2, tag in CONTENT_TAGS
                elif said == 0 and not (tag == "header" and zone == 2):
                    inner, firm = 0, tag in OTHER_TAGS
                stack.append((tag, inner, firm))
                opened[tag] += 1
            zone, by_tag = stack[-1][1:] if stack else (1, False)
    if done < len(page):
        parts.append(html.unescape(page[done:]))
    close()
    return out


class Tree(NamedTuple):
    feature: int
    cut: float
    low: Tree | bool
    high: Tree | bool


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> Tree | bool:
    """A classification tree by Gini impurity; ties go to the first feature and the lowest cut."""
    if depth == 0 or y.all() or not y.any():
        return bool(y.mean() >= 0.5)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            p, q = y[low].mean(), y[~low].mean()
            impurity = low.mean() * p * (1 - p) + (1 - low.mean()) * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, cut, low
    if best is None:
        return bool(y.mean() >= 0.5)
    _, f, cut, low = best
    return Tree(f, float(cut), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


@lru_cache(maxsize=1)
def trained() -> Tree | bool:
    rows = np.array([line.split() for line in LABELLED.strip().splitlines()], float)
    return grow(rows[:, :-1], rows[:, -1] == 1)


def keeps(tree: Tree | bool, row: tuple) -> bool:
    while isinstance(tree, Tree):
        tree = tree.low if row[tree.feature] <= tree.cut else tree.high
    return tree


def main_text(page: str) -> str:
    found = blocks(page)
    edge = Block("", 0, 0.0, 1, False)
    tree = trained()
    kept = []
    for before, b, after in zip([edge, *found], found, [*found[1:], edge], strict=False):
        row = (b.words, b.links, before.words, before.links, after.words, after.links, b.zone, b.heading)
        if keeps(tree, row):
            kept.append(b.text)
    return "\n".join(kept)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """`page_id, url, text, n_chars` of every page."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        keys, urls, column = batch.columns
        for lo, hi, _ in slices(column):
            texts = [main_text(p or "") for p in column.slice(lo, hi - lo).to_pylist()]
            yield {"page_id": keys.slice(lo, hi - lo), "url": urls.slice(lo, hi - lo), "text": texts, "n_chars": [len(t) for t in texts]}

    columns = pages.select(F.col(f"`{key}`").alias("k"), F.col(f"`{url}`").alias("u"), F.col(f"`{page}`").alias("h"))
    return arrow_stage(columns, "page_id long, url string, text string, n_chars long", run)
