"""Edit-aware token counts.

A document's pre-tokens are the leaves of a segment tree that sums characters and tokens. The leaves of every document
are kept in a table; a later pass builds the trees of documents with edits from them, without splitting or encoding the
text again. An edit re-splits only the leaves it touches, the context that can change how they are split, and what
follows until the new splits fall in with the old; only pre-tokens that come up new are encoded, and sums change on the
paths to the root.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordspan.llm.bpe import QUEUE_CHARS, Chunks, encode_many, merges_of, splitter
from wordspan.llm.common import arrow_pass, stage, texts

#: What the registered query edits out: e-mail and IP addresses, and long numbers. An address's local part is tried from
#: its first character only and given up whole, so the time is in proportion to the text.
NUMBERS = r"\b\d{1,3}(?:\.\d{1,3}){3}\b|\+?\d[\d() -]{5,}\d"
PERSONAL = re.compile(rf"(?<![\w.+-])[\w.+-]++@[\w-]++(?:\.[\w-]++)++|{NUMBERS}")
WITHOUT_AT = re.compile(NUMBERS)
#: Runs that hold all matches of NUMBERS: quick to find as most texts have few.
RUN = re.compile(r"[\d+][\d() .-]{6,}")
REMOVED = "[removed]"
#: Tokens that the memo of pre-tokens holds at most.
MOST_PIECES = 100_000

Edit = tuple[int, int, str]  # start, end, replacement, in code points of the text before any edit


class PieceCounts:
    """Tokens of a pre-token, from a memo of bounded size."""

    def __init__(self, path: str, pattern: str, most: int = MOST_PIECES, longest: int = 64):
        self.merges, self.find, self.most, self.longest = merges_of(path), regex.compile(pattern).findall, most, longest
        self.split = splitter(pattern)
        self.memo: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        new = [p for p in dict.fromkeys(pieces) if p not in self.memo]
        found = dict(zip(new, (len(x) // 4 for x in encode_many([p.encode() for p in new], self.merges)), strict=True)) if new else {}
        memo = self.memo
        out = [memo[p] if p in memo else found[p] for p in pieces]
        self.learn(found)
        return out

    def learn(self, found: dict[str, int]) -> None:
        if len(self.memo) + len(found) > self.most:
            self.memo = {}
        if len(found) <= self.most:
            self.memo.update((p, n) for p, n in found.items() if len(p) <= self.longest)

    def leaves(self, strings: list[str]) -> list[bytes]:
        """Each string's leaves: characters and tokens of its pre-tokens in turn, as little-endian 32-bit numbers."""
        flat, spans = self.split(strings)
        met = list(set(flat))
        tokens = [len(x) // 4 for x in encode_many([p.encode() for p in met], self.merges)]
        raw = np.stack([np.array(list(map(len, met)), "<u4"), np.array(tokens, "<u4")], axis=1).tobytes()
        known = {p: raw[8 * i : 8 * i + 8] for i, p in enumerate(met)}
        found = list(map(known.__getitem__, flat))
        return [found[a] if b == a + 1 else b"".join(found[a:b]) for a, b in spans]


class Tree:
    """A document's text by pre-token. A leaf may come to hold several pre-tokens, or none; the shape stays.

    `leaves`: what an earlier pass kept of the text; without it the text is split and encoded here.
    """

    def __init__(self, text: str, pieces: PieceCounts, leaves: bytes | None = None):
        self.pieces = pieces
        if leaves is None:
            leaves = pieces.leaves([text])[0]
        chars, tokens = np.frombuffer(leaves, "<u4").reshape(-1, 2).T
        n = len(chars)
        self.parts: list[list[str]] = [[text[a:b]] for a, b in pairwise(accumulate(chars.tolist(), initial=0))]
        self.counts: list[list[int]] = [[k] for k in tokens.tolist()]
        self.base = 1 << max(0, (n - 1).bit_length())
        self.chars, self.tokens = np.zeros(2 * self.base, np.int64), np.zeros(2 * self.base, np.int64)
        self.chars[self.base : self.base + n], self.tokens[self.base : self.base + n] = chars, tokens
        level = self.base
        while level > 1:
            for sums in (self.chars, self.tokens):
                sums[level // 2 : level] = sums[level : 2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2
        self.encoded = 0

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def packed(self) -> bytes:
        """The leaves as they are now, to be kept for a later load."""
        sizes = [(len(p), k) for part, own in zip(self.parts, self.counts, strict=True) for p, k in zip(part, own, strict=True)]
        return np.array(sizes, "<u4").tobytes()

    def text(self) -> str:
        return "".join(p for part in self.parts for p in part)

    def leaf_at(self, offset: int) -> tuple[int, int]:
        """The leaf that holds the character at `offset`, and where the leaf begins."""
        node, begin = 1, 0
        while node < self.base:
            node *= 2
            if offset - begin >= self.chars[node]:
                begin += int(self.chars[node])
                node += 1
        return node - self.base, begin

    def put(self, leaf: int, part: list[str], counts: list[int]) -> None:
        self.parts[leaf], self.counts[leaf] = part, counts
        node = self.base + leaf
        self.chars[node], self.tokens[node] = sum(map(len, part)), sum(counts)
        while node > 1:
            node //= 2
            for sums in (self.chars, self.tokens):
                sums[node] = sums[2 * node] + sums[2 * node + 1]

    def before(self, leaf: int) -> int:
        """The last leaf before this one that isn't empty, or -1."""
        leaf -= 1
        while leaf >= 0 and not self.parts[leaf]:
            leaf -= 1
        return leaf

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces the characters from start to end (before this edit) by `new`."""
        n = int(self.chars[1])
        if not self.parts:
            self.__init__(new, self.pieces)
            self.encoded += len(self.parts)
            return
        first, begin = self.leaf_at(min(start, n - 1))
        # The pre-token before may go on into the new text, and runs of white space are split from their end.
        while (leaf := self.before(first)) >= 0:
            held = self.parts[first]
            first, begin = leaf, begin - int(self.chars[self.base + leaf])
            if not self.parts[leaf][-1].isspace() and held is not None:
                break
        last, at = first, begin
        while last + 1 < len(self.parts) and at + self.chars[self.base + last] < end:
            at += int(self.chars[self.base + last])
            last += 1
        more = 2
        while True:
            stop = min(len(self.parts), last + 1 + more)
            # Old boundaries after the edit, as offsets in the changed region.
            region = "".join(p for part in self.parts[first:stop] for p in part)
            changed = region[: start - begin] + new + region[end - begin :]
            shift, bounds, offset = len(new) - (end - start), {}, 0
            for leaf in range(first, stop):
                for p in self.parts[leaf]:
                    offset += len(p)
                if offset >= end - begin:
                    bounds[offset + shift] = leaf
            pieces, place, done = self.pieces.find(changed), 0, None
            for k, p in enumerate(pieces):
                place += len(p)
                # A boundary at the region's own end doesn't count unless it is the text's: splits look ahead.
                if place in bounds and place >= start - begin + len(new) and (place < len(changed) - 1 or stop == len(self.parts)):
                    if place < len(changed) or stop == len(self.parts):
                        done = k + 1, bounds[place]
                        break
            if done is not None or stop == len(self.parts):
                break
            more *= 4
        used, last = done if done is not None else (len(pieces), stop - 1)
        fresh = pieces[:used]
        self.encoded += len(fresh)
        self.put(first, fresh, self.pieces.counts(fresh))
        for leaf in range(first + 1, last + 1):
            if self.parts[leaf]:
                self.put(leaf, [], [])


def personal_edits(text: str) -> list[Edit]:
    if "@" in text:
        found = PERSONAL.finditer(text)
    else:  # a run and the character after it, which a match's end may depend on
        found = (m for run in RUN.finditer(text) for m in WITHOUT_AT.finditer(text, run.start(), run.end() + 1))
    return [(m.start(), m.end(), REMOVED) for m in found]


@lru_cache(1)
def piece_counts(path: str, pattern: str) -> PieceCounts:
    return PieceCounts(path, pattern)


EDITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("new", pa.string())]))


def leaf_table(docs: DataFrame, path: str, pattern: str, edits: Callable[[str], list[Edit]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, leaves (the packed leaves of its tree), edits and text of every row; no shuffle.

    `edits` gives a text's edits in order, not overlapping, as offsets into the text as it was. The text is carried only
    where it has edits to come; null and empty texts have no leaves.
    """

    def each():
        chunks = Chunks(piece_counts(path, pattern).leaves, chars=QUEUE_CHARS)

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = texts(batch, text_col)
            packed = list(chunks.encoded(values))
            tokens = [int(np.frombuffer(x, "<u4")[1::2].sum(dtype=np.int64)) for x in packed]
            changes = [edits(t) if edits else [] for t in values]
            listed = pa.array([[{"start": a, "end": b, "new": new} for a, b, new in own] for own in changes], EDITS)
            kept = pa.array([t if own else None for t, own in zip(values, changes, strict=True)], pa.string())
            return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(tokens, pa.int64()), pa.array(packed, pa.binary()), listed, kept], ["doc_id", "n_tokens", "leaves", "edits", "text"])

        return turn

    return arrow_pass(docs.select(id_col, text_col), each, "doc_id long, n_tokens long, leaves binary, edits array<struct<start: long, end: long, new: string>>, text string")


def apply_edits(table: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_edited, n_reencoded, text and leaves after the edits, for rows of a leaf table.

    Trees are built from the kept leaves. Rows without edits pass as they are, with a null text; no shuffle.
    """
    kinds = "n_edits long, n_tokens_edited long, n_reencoded long, text string, leaves binary"

    def each():
        pieces = piece_counts(path, pattern)

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for n, leaves, changes, text in zip(*(batch.column(c).to_pylist() for c in ("n_tokens", "leaves", "edits", "text")), strict=True):
                if not changes:
                    rows.append((0, n, 0, None, leaves))
                    continue
                if any(b["start"] < a["end"] for a, b in pairwise(changes)) or changes[0]["start"] < 0 or any(c["end"] < c["start"] or c["end"] > len(text) for c in changes):
                    raise ValueError("edits overlap or reach beyond their text")
                tree = Tree(text, pieces, leaves)
                for change in reversed(changes):  # from the end, so that offsets stay true
                    tree.edit(change["start"], change["end"], change["new"])
                rows.append((len(changes), tree.total, tree.encoded, tree.text(), tree.packed()))
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.string(), pa.binary()], strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), *arrays], ["doc_id", "n_tokens", *(k.split()[0] for k in kinds.split(", "))])

        return turn

    return arrow_pass(table.select("doc_id", "n_tokens", "leaves", "edits", "text"), each, f"doc_id long, n_tokens long, {kinds}")


def edited_table(table: DataFrame, docs: DataFrame, edits: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A leaf table after edits that came later: doc_id, n_tokens, leaves, n_edits and n_reencoded of all its rows.

    `docs` has the texts as they were when the table was made or last edited, `edits` (id, start, end, new) what becomes
    of them, as offsets into those texts. Only the texts of edited documents are fetched, and of those only what the
    edits touch is encoded; the leaves of others pass as they are. Ids are unique in table and docs; edits of unknown and
    null ids change nothing. Edits that overlap, or reach beyond their text, raise ValueError. Written and read back, the
    result is the table for the next edits.
    """
    change = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.coalesce("new", F.lit("")).alias("new"))
    listed = edits.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.array_sort(F.collect_list(change)).alias("edits"))
    held = docs.join(listed.select(F.col("doc_id").alias(id_col)), id_col, "left_semi").select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    plain = table.select("doc_id", "n_tokens", "leaves")
    touched = plain.join(listed, "doc_id").join(held, "doc_id")
    made = apply_edits(touched, path, pattern).select("doc_id", F.col("n_tokens_edited").alias("n_tokens"), "leaves", "n_edits", "n_reencoded")
    none = F.lit(0).cast("long")
    left = plain.join(touched.select("doc_id"), "doc_id", "left_anti").select("doc_id", "n_tokens", "leaves", none.alias("n_edits"), none.alias("n_reencoded"))
    return made.unionByName(left)


def count_edited(docs: DataFrame, path: str, pattern: str, edits: Callable[[str], list[Edit]] = personal_edits, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_edited and n_reencoded (pre-tokens encoded again) of every row; no shuffle.

    The leaf table is written once, then the edits are applied to it. Null and empty texts have no tokens; without edits
    both counts are equal and nothing is encoded again. Repeated rows each count, null ids are carried, an empty table
    gives no rows, other columns are not read.
    """
    kept = stage(leaf_table(docs, path, pattern, edits, id_col, text_col), compression="zstd")
    edited = apply_edits(kept.where(F.size("edits") > 0), path, pattern).drop("text", "leaves")
    same = kept.where(F.size("edits") == 0).select("doc_id", "n_tokens", F.lit(0).cast("long").alias("n_edits"), F.col("n_tokens").alias("n_tokens_edited"), F.lit(0).cast("long").alias("n_reencoded"))
    return edited.unionByName(same)
