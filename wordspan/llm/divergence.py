"""How far the sources of a language are from each other, by hash-consed segment trees over term ids.

Terms are counted in the tasks that read the texts and added up by a shuffle. The terms that a language keeps are dealt
by a hash into blocks, and a block's counts into segment trees, one for each source: the frequent terms first, so that
the many rare ones make long runs of zeros. Trees are interned level by level, over all sources of the task: equal
subtrees are one node, whichever source or place they are from. Two trees are then walked at once, from the roots down:
of each level only the distinct pairs of nodes go on, so a pair of equal runs is priced once however often it stands
there, and prices are added up on the way back. A source against its language is walked the same way, past the nodes
without a count.

A task holds one block of terms for two blocks of sources, so neither a large vocabulary, a frequent term nor a language
with many sources grows it. Sums and ranks are Spark's.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordspan.llm.common import stage

#: A term of a UTF-8 text: ASCII letters and whatever isn't ASCII. bytes.lower() lowers A-Z only.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")
#: Bytes of a text that are cut into terms at once; entries that a task counts before it hands them on.
SLICE, HELD = 4 << 20, 400_000
#: Terms of a block, and sources of one.
TERMS, SOURCES = 8192, 64


def slices(raw: bytes, breaks: re.Pattern, size: int = SLICE) -> Iterator[bytes]:
    """The text in slices of about that size that end where no word does."""
    at = 0
    while len(raw) - at > size:
        end = breaks.search(raw, at + size)
        if end is None:
            break
        yield raw[at : end.start()]
        at = end.start()
    yield raw[at:] if at else raw


COUNTED = {"lang": pa.string(), "source": pa.string(), "term": pa.string(), "n": pa.int64(), "docs": pa.int64()}


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of (lang, source, text) rows: occurrences and rows that have them, by group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            k = len(n)
            columns = [pa.array([lang], pa.string()).take(pa.array(np.zeros(k, np.int64))), pa.array([source], pa.string()).take(pa.array(np.zeros(k, np.int64)))]
            columns += [pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())]
            yield pa.record_batch(columns, names=list(COUNTED))
        held.clear()

    new = 0
    for batch in batches:
        for lang, source, raw in zip(*(batch.column(c).to_pylist() for c in ("lang", "source")), batch.column("text").cast(pa.binary()), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, own = len(n), set()
            for part in slices(raw.as_py().lower(), BREAK):
                words = TERM.findall(part)
                n.update(words)
                own.update(words)
            docs.update(own)
            new += len(n) - before
            if new >= HELD:
                yield from out()
                new = 0
    yield from out()


def shares(counts: np.ndarray, total: int, kept: int, scale: int) -> np.ndarray:
    """1 + floor(scale * (count + 1) / (total + kept)), exactly."""
    if len(counts) and scale * (int(counts.max()) + 1) >= 1 << 63:
        counts = counts.astype(object)
    return (1 + scale * (counts + 1) // (total + kept)).astype(np.int64)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Trees:
    """Segment trees over the columns of a matrix of counts, one for each row, with shared nodes.

    levels[0] is over leaves: a node of level k has two children of level k - 1, in left[k] and right[k]. Leaf 0 stands
    for no term at all, where the columns are filled up to a power of two.
    """

    def __init__(self, counts: np.ndarray):
        rows, terms = counts.shape
        values, ids = np.unique(counts, return_inverse=True)
        self.values = np.append([-1], values)
        width = 1 << max(0, (terms - 1).bit_length())
        nodes = np.zeros((rows, width), np.int64)
        nodes[:, :terms] = ids.reshape(rows, terms) + 1
        self.sizes, self.left, self.right = [len(self.values)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while width > 1:
            pairs, ids = np.unique(nodes[:, ::2] * self.sizes[-1] + nodes[:, 1::2], return_inverse=True)
            self.left.append(pairs // self.sizes[-1])
            self.right.append(pairs % self.sizes[-1])
            self.sizes.append(len(pairs))
            width //= 2
            nodes = ids.reshape(rows, width)
        self.roots = nodes[:, 0]
        self.blank = [self.values <= 0]  # which nodes of a level have no count
        for k in range(1, len(self.sizes)):
            self.blank.append(self.blank[-1][self.left[k]] & self.blank[-1][self.right[k]])

    def price(self, a: int, b: int, leaf) -> int:
        """The sum over all terms of leaf(counts of a, counts of b), each distinct pair of nodes worked out once."""
        pairs, back = np.array([self.roots[a] * self.sizes[-1] + self.roots[b]]), []
        for level in range(len(self.sizes) - 1, 0, -1):
            x, y = np.divmod(pairs, self.sizes[level])
            size = self.sizes[level - 1]
            below = [side[level][x] * size + side[level][y] for side in (self.left, self.right)]
            pairs, at = np.unique(np.concatenate(below), return_inverse=True)
            back.append(at)
        x, y = (self.values[k] for k in np.divmod(pairs, self.sizes[0]))
        real = x >= 0
        worth = np.zeros(len(pairs), np.int64)
        worth[real] = leaf(x[real], y[real])
        for at in reversed(back):
            half = len(at) // 2
            worth = worth[at[:half]] + worth[at[half:]]
        return int(worth[0])

    def counts(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where a has a count, and the distinct leaf of a and that of b there; nodes of a without one are passed over."""
        at, x, y = np.zeros(1, np.int64), self.roots[[a]], self.roots[[b]]
        for level in range(len(self.sizes) - 1, 0, -1):
            at = np.concatenate([2 * at, 2 * at + 1])
            x, y = (np.concatenate([self.left[level][n], self.right[level][n]]) for n in (x, y))
            some = ~self.blank[level - 1][x]
            at, x, y = at[some], x[some], y[some]
        some = self.values[x] > 0
        return at[some], x[some], y[some]


PRICED = "lang string, source string, part string, item string, value long"


def pricer(scale: int, most: int):
    """A task's work on a block of terms: pairs of sources from two blocks of them, and each source's own best terms."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lang, _, i, j = key
        marks = pdf[pdf["term"].isna()].drop_duplicates("place").sort_values("place")
        width, kept, whole = (int(marks[c].iloc[0]) for c in ("width", "kept", "lang_total"))
        rows = pdf[pdf["term"].notna()]
        totals = rows.drop_duplicates("term").sort_values(["total", "term"], ascending=[False, True])
        terms = totals["term"].to_numpy(object)
        alphabetic = np.argsort(np.argsort(terms))
        counts = np.zeros((len(marks) + 1, width), np.int64)
        if len(rows):
            row, column = pd.Index(marks["place"]), pd.Index(terms)
            counts[row.get_indexer(rows["place"]), column.get_indexer(rows["term"])] = rows["n"]
            counts[-1, : len(terms)] = totals["total"]
        trees = Trees(counts) if width else None
        names, sums, block = marks["source"].tolist(), marks["total"].tolist(), (marks["place"] // SOURCES).tolist()
        out = []
        for a in range(len(names)):
            if block[a] != i:
                continue
            for b in range(len(names)):
                if block[b] == j and a != b:
                    out.append((names[a], "pair", names[b], trees.price(a, b, lambda x, y, a=a, b=b: distance(shares(x, sums[a], kept, scale), shares(y, sums[b], kept, scale))) if trees else 0))
            if i == j and trees:
                at, x, y = trees.counts(a, len(names))
                pairs, back = np.unique(x * trees.sizes[0] + y, return_inverse=True)
                p = shares(trees.values[pairs // trees.sizes[0]], sums[a], kept, scale)
                q = shares(trees.values[pairs % trees.sizes[0]], whole, kept, scale)
                more, worth = (p > q)[back], distance(p, q)[back]
                at, worth = at[more], worth[more]
                first = np.lexsort((alphabetic[at], -worth))[:most]
                out += [(names[a], "term", t, v) for t, v in zip(terms[at[first]], worth[first].tolist(), strict=True)]
        return pd.DataFrame([(lang, *x) for x in out], columns=["lang", "source", "part", "item", "value"])

    return run


def divergence(docs: DataFrame, least_docs: int = 3, most_terms: int = 200, scale: int = 1_000_000_000, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how far every source of a language is from the others and from the whole.

    Part "pair" holds every other source of the language; value is the sum of floor((p - q)^2 / q) over the terms that
    the language keeps, which at least `least_docs` of its rows have; p and q are smoothed shares of a term in the two
    sources. Part "term" holds the terms a source has more of than its language, the `most_terms` of the highest values.
    Ranks go from 1 by falling value, then by the item's UTF-8.

    Null text, lang and source count as ''. Rows are documents: those that repeat, or share an id, count each. A source
    without kept terms has counts of 0; in a language that keeps none all pairs have value 0. An empty table gives none.
    """
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    parts = plain.mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    sums = stage(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = sums.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    blocks = F.greatest(F.lit(1), F.ceil(F.coalesce("kept", F.lit(0)) / TERMS)).cast("int")
    block: Column = F.pmod(F.xxhash64("term"), "blocks").cast("int")
    dealt = stage(kept.join(sizes.withColumn("blocks", blocks), "lang").select("lang", "term", "total", block.alias("block")))
    own = stage(sums.join(dealt, ["lang", "term"]).select("lang", "block", "source", "term", "n", "total"))
    groups = plain.select("lang", "source").distinct()
    by_source = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sources = stage(groups.join(by_source, ["lang", "source"], "left").fillna(0, "total").join(sizes, "lang", "left").fillna(0, ["kept", "lang_total"]).withColumns({"place": place, "blocks": blocks}))
    halves = sources.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("int").alias("parts"))
    widths = dealt.groupBy("lang", "block").agg(F.count("*").alias("width"))
    marks = sources.join(halves, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(widths, ["lang", "block"], "left")
    marks = marks.select("lang", "block", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total", "place", "parts", F.coalesce("width", F.lit(0)).alias("width"), "kept", "lang_total")
    rows = own.join(sources.join(halves, "lang").select("lang", "source", "place", "parts"), ["lang", "source"])
    both = marks.unionByName(rows.select("lang", "block", "source", "term", "n", "total", "place", "parts", *(F.lit(0).cast("long").alias(c) for c in ("width", "kept", "lang_total"))))
    half = F.floor(F.col("place") / SOURCES).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    cells = F.array_distinct(F.concat(F.transform(others, lambda o: F.struct(half.alias("i"), o.alias("j"))), F.transform(others, lambda o: F.struct(o.alias("i"), half.alias("j")))))
    sent = both.select("lang", "block", F.inline(cells), "source", "term", "n", "total", "place", "width", "kept", "lang_total")
    priced = stage(sent.groupBy("lang", "block", "i", "j").applyInPandas(pricer(scale, most_terms), PRICED))
    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = priced.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= most_terms)
    return pairs.withColumn("rank", rank).unionByName(terms)
