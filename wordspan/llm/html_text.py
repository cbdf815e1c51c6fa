"""Main text of web pages: flat text blocks, classified by a decision tree over the block and its neighbours.

A page is cut into blocks at block-level tags. A block's features are its words and link density, those of the blocks
before and after it, the elements it stands in, and what the names (class, id) of those elements say, but for the names
of the article element itself. Both the tree and the weights of names are learnt from the labelled pages in
labelled_pages.py; the tree also from copies of other lengths and without names, where words and links of a block and
its neighbours must tell. Pages are scanned once from left to right.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wordspan.llm import labelled_pages
from wordspan.llm.common import arrow_pass, texts

#: A tag, up to its end outside quoted values; nothing is tried twice, so the time is in proportion to the page.
TAG = re.compile(r"""(/?+)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
#: Elements whose text is never shown or is no text of the page's own.
SILENT = frozenset("script style noscript template svg math textarea select button iframe object canvas audio video head title".split())
#: Of those, the ones whose content is raw: it ends at their own end tag only.
RAW = frozenset("script style textarea title iframe noscript".split())
#: Tags that can stand in head; any other ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head".split())
#: Elements that stand on lines of their own.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul head".split())
#: Blocks that have no end of their own but that of others, or none at all; they are not kept on the stack.
LEAF = frozenset("p hr li dt dd tr td th tbody thead tfoot caption h1 h2 h3 h4 h5 h6 html body".split())
#: What kind of block a tag opens: 1 paragraphs, 2 headings, 3 items of lists, 4 cells of tables; 0 all others.
KIND = dict.fromkeys("p blockquote pre".split(), 1) | dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 2) | dict.fromkeys("li dt dd".split(), 3) | dict.fromkeys("td th caption figcaption".split(), 4)
APART = frozenset("nav aside footer form menu dialog".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
#: The most that the names of one element say, either way.
MOST_SAID = 3.0


@dataclass
class Block:
    text: str
    words: int
    links: float
    main: bool
    apart: bool
    kind: int
    names: tuple[tuple[str, ...], ...]  # the parts of class and id, for each element around the block that has any


@dataclass
class Element:
    """What holds in an open element, with all that is around it."""

    name: str
    main: bool = False
    apart: bool = False
    names: tuple[tuple[str, ...], ...] = ()


@dataclass
class Cutter:
    """Goes through a page's tags once and collects its blocks."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[Element] = field(default_factory=lambda: [Element("")])
    open_names: Counter = field(default_factory=Counter)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    in_link: bool = False
    leaf: Element | None = None  # the leaf block that is open

    def say(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.in_link:
                self.linked.append(raw)

    def end_block(self) -> None:
        if self.parts:
            words = html.unescape("".join(self.parts)).split()
            if words:
                linked = len(html.unescape(" ".join(self.linked)).split())
                at = self.leaf or self.stack[-1]
                self.blocks.append(Block(" ".join(words), len(words), min(1.0, linked / len(words)), at.main, at.apart, KIND.get(at.name, 0), at.names))
            self.parts, self.linked = [], []

    def open(self, name: str, attributes: str) -> None:
        if name == "a":
            self.in_link = True
        elif name == "br":
            self.say(" ")
        if name not in BLOCK:
            return
        self.end_block()
        self.in_link = False
        around = self.stack[-1]
        names, role, hidden = described(attributes)
        main = around.main or name in ("article", "main") or role == "main"
        apart = around.apart or hidden or name in APART or role in ROLES or (name == "header" and not around.main)
        # the article element's own names and those around it say nothing about it; of those within, the nearest sixteen count
        begins = main and not around.main
        element = Element(name, main, apart, () if begins else (*around.names[-15:], names) if names else around.names)
        if name in LEAF:
            self.leaf = element if name not in ("html", "body") else None
        elif not attributes.rstrip().endswith("/"):
            self.leaf = None
            self.stack.append(element)
            self.open_names[name] += 1

    def close(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name not in BLOCK:
            return
        self.end_block()
        if name in LEAF:
            self.leaf = None if self.leaf is None or self.leaf.name == name else self.leaf
        elif self.open_names[name]:
            self.leaf = None
            while (gone := self.stack.pop().name) != name:
                self.open_names[gone] -= 1
            self.open_names[name] -= 1


def described(attributes: str) -> tuple[tuple[str, ...], str, bool]:
    """Parts of class and id, the role, and whether the element is hidden."""
    names, role, hidden = [], "", False
    if attributes.strip(" /"):
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id"):
                names += re.findall(r"[^\W\d_]+", value)
            elif name == "role":
                role = value
            else:
                hidden = hidden or (bool(HIDDEN.search(value)) if name == "style" else name == "hidden" or value == "true")
    return tuple(names), role, hidden


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order. Unclosed elements end with the page; stray end tags are skipped.

    A silent element ends at its own end tag or with a block around it; head ends at the first tag that can't stand in
    it. What follows a comment or tag without an end is no text, as in browsers.
    """
    cutter, at, silent, inner = Cutter(), 0, "", Counter()
    while (begin := page.find("<", at)) >= 0:
        after = page[begin + 1 : begin + 2]
        if after in ("!", "?"):
            comment = page.startswith("<!--", begin)
            end = page.find("-->", begin + 4) if comment else page.find(">", begin)
            m = None
        elif not (after == "/" or (after.isascii() and after.isalpha())) or page[begin + 1 : begin + 3] in ("/", "/ "):
            if not silent:
                cutter.say(page[at : begin + 1])
            at = begin + 1
            continue
        else:
            m = TAG.match(page, begin + 1)
            if m is None and after == "/" and not page[begin + 2 : begin + 3].isalpha():  # </> and the like
                end, comment = page.find(">", begin), False
            else:
                end, comment = (m.end() - 1 if m else -1), False
        if not silent:
            cutter.say(page[at:begin])
        if end < 0:
            at = len(page)
            break
        at = end + (3 if comment else 1)
        if m is None:
            continue
        end, name = m[1], m[2].lower()
        if silent == "head" and not end and name not in IN_HEAD:
            silent = ""
        if silent:
            if not end and name in RAW:
                close = raw_end(name).search(page, at)
                at = close.end() if close else len(page)
                continue
            if end and name == silent:
                silent = ""
            elif name in BLOCK and not end:
                inner[name] += 1
            elif name in BLOCK and inner[name]:
                inner[name] -= 1
            elif end and ((cutter.leaf and name == cutter.leaf.name) or cutter.open_names[name]):
                silent = ""
                cutter.close(name)
        elif end:
            cutter.close(name)
        elif name in SILENT:
            if name in RAW:
                close = raw_end(name).search(page, at)
                at = close.end() if close else len(page)
            elif not m[3].rstrip().endswith("/"):
                silent, inner = name, Counter()
            if name not in ("script", "style"):
                cutter.say(" ")
        else:
            cutter.open(name, m[3])
    if not silent:
        cutter.say(page[at:])
    cutter.end_block()
    return cutter.blocks


@lru_cache(32)
def raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}[^>]*>", re.I)


def rows_of(blocks: list[Block], weights: dict[str, float]) -> list[tuple[float, ...]]:
    """Each block's features: words and link density of it, of the block before and the block after; where it stands (in
    the article or main element 1, on a page that has none 0, beside it -1); whether it is in navigation, a form or the
    like; its kind; and what the names around it say."""
    has_main = any(b.main for b in blocks)
    around = [(0, 0.0), *((b.words, b.links) for b in blocks), (0, 0.0)]
    return [(*around[i + 1], *around[i], *around[i + 2], (1 if b.main else -1) if has_main else 0, int(b.apart), b.kind, said(b.names, weights)) for i, b in enumerate(blocks)]


def said(names: tuple[tuple[str, ...], ...], weights: dict[str, float]) -> float:
    """The sum over the elements around a block of what the parts of their names weigh, bounded for each element."""
    return sum(max(-MOST_SAID, min(MOST_SAID, sum(weights.get(part, 0.0) for part in own))) for own in names)


def name_weights(pages: list[tuple[list[Block], list[bool]]]) -> dict[str, float]:
    """How much likelier each part of a name is on a labelled page around a block that is kept, as a logarithm.

    Each element counts once, by the share of kept blocks in it, so that long articles don't outweigh.
    """
    seen: dict[str, list[float]] = {}
    for blocks, kept in pages:
        elements: dict[tuple, list[bool]] = {}
        for b, k in zip(blocks, kept, strict=True):
            for depth in range(len(b.names)):
                elements.setdefault(b.names[: depth + 1], []).append(k)
        for path, marks in elements.items():
            for part in path[-1]:
                seen.setdefault(part, []).append(sum(marks) / len(marks))
    return {part: log((sum(x) + 0.25) / (len(x) - sum(x) + 0.25)) for part, x in seen.items()}


#: Rows that a leaf of the tree has at least, and questions on the way to it at most.
LEAST_ROWS, DEPTH = 8, 8


def grow(rows: np.ndarray, depth: int = DEPTH):
    """A decision tree by Gini impurity over rows of features and a last column, 1 for blocks that are kept.

    (feature, threshold, at most, above), or the share of kept blocks in a leaf.
    """
    kept, n = rows[:, -1].sum(), len(rows)
    if not depth or kept in (0, n) or n < 2 * LEAST_ROWS:
        return float(kept / n)
    best = None
    for k in range(rows.shape[1] - 1):
        order = np.argsort(rows[:, k], kind="stable")
        values, ones = rows[order, k], np.cumsum(rows[order, -1])
        left = np.arange(1, n)
        impurity = ones[:-1] * (left - ones[:-1]) / left + (kept - ones[:-1]) * (n - left - kept + ones[:-1]) / (n - left)
        fits = (values[1:] > values[:-1]) & (left >= LEAST_ROWS) & (n - left >= LEAST_ROWS)
        if fits.any():
            at = int(np.argmin(np.where(fits, impurity, np.inf)))
            if best is None or impurity[at] < best[0] - 1e-12:
                best = (impurity[at], k, float(values[at] + values[at + 1]) / 2)
    if best is None or best[0] > kept * (n - kept) / n - 1e-9:
        return float(kept / n)
    _, k, split = best
    return k, split, grow(rows[rows[:, k] <= split], depth - 1), grow(rows[rows[:, k] > split], depth - 1)


def marked_pages(pages: list[str]) -> list[tuple[list[Block], list[bool]]]:
    return [(blocks, [b.text.startswith(labelled_pages.OWN) for b in blocks]) for blocks in map(blocks_of, pages)]


#: Places of features in rows_of: where a block stands.
STANDS = 6


@lru_cache(1)
def trained():
    """The weights of names, from the labelled pages, and the tree, from them and their copies.

    Its first questions are whether the page says where its article is; pages that do and pages that don't each have
    a tree of their own below them.
    """
    weights = name_weights(marked_pages(list(map(labelled_pages.filled, labelled_pages.PAGES))))
    marked = marked_pages(labelled_pages.training_pages())
    rows = np.array([(*row, int(k)) for blocks, kept in marked for row, k in zip(rows_of(blocks, weights), kept, strict=True)], float)
    says = rows[:, STANDS] != 0
    with_element, without = grow(rows[says]), grow(rows[~says])
    return weights, (STANDS, -0.5, with_element, (STANDS, 0.5, without, with_element))


def is_article(row: tuple[float, ...]) -> bool:
    node = trained()[1]
    while isinstance(node, tuple):
        k, split, low, high = node
        node = low if row[k] <= split else high
    return node > 0.5


def main_text(page: str) -> str:
    """The article's blocks, joined by a space."""
    blocks = blocks_of(page)
    return " ".join(b.text for b, row in zip(blocks, rows_of(blocks, trained()[0]), strict=True) if is_article(row))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row; no shuffle.

    Null and empty pages, and pages without article, have empty text. Repeated rows each have theirs, null ids are
    carried, other columns are not read, an empty table gives no rows. Pages of any length are read whole, in time in
    proportion to their length, unclosed tags and comments included.
    """

    def each():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = list(map(main_text, texts(batch, html_col)))
            return pa.RecordBatch.from_arrays([batch.column(id_col), batch.column(url_col), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

        return turn

    return arrow_pass(pages.select(id_col, url_col, html_col), each, "page_id long, url string, text string, n_chars long")
