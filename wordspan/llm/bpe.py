"""Byte-level BPE by a rank queue: encoding, decoding and the pass that does both for whole documents.

The bytes of all pre-tokens of a batch form one linked list, cut between pre-tokens. Every adjacent pair that may merge
waits in the bucket of its merge rank, and a bitmap in three levels says which buckets hold anything: find-first-set
gives the next rank without comparing pairs. A bucket's pairs merge together, as arrays; entries whose pair has changed
since they were filed are skipped. Pre-tokens don't touch each other, so the order of ranks over the whole batch is the
order of ranks within each. Where a merge may bring up a lower rank beside it, those of one pre-token merge one after
the other; a pre-token with many such places leaves the arrays and goes on by a queue of single positions, so the time
grows with the bytes (times a logarithm), however long a pre-token is.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wordspan.llm.common import arrow_pass, texts

#: A space that follows no white space begins a chunk: no pre-token of the pattern spans such a place.
BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
#: White space before a space; of that, what ASCII texts can hold.
MIXED = [c + " " for c in map(chr, range(0x3001)) if c.isspace()]
MIXED_ASCII = [x for x in MIXED if x.isascii()]
#: Bytes that the ids of chunks met before may take in a Python worker, and what an entry takes besides its strings.
MEMO_BYTES, ENTRY = 64 << 20, 200
#: Characters of the texts whose chunks are held at once; and where the queue encodes them, as its rounds cost the same
#: for few chunks and many.
CUT_CHARS, QUEUE_CHARS = 2 << 20, 8 << 20
#: Places in one pre-token where a merge that may disturb its neighbours waits, from which on the pre-token goes on alone.
MANY = 16


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file in the tiktoken format: base64 of the bytes, then the rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Arrays of positions waiting by rank. The bitmap's leaves mark full buckets, the levels above nonzero words of 64."""

    def __init__(self):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.levels: list[dict[int, int]] = [{}, {}, {}]

    def push(self, rank: int, positions: np.ndarray) -> None:
        waiting = self.buckets.get(rank)
        if waiting is not None:
            waiting.append(positions)
            return
        self.buckets[rank] = [positions]
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            old = level.get(word, 0)
            level[word] = old | bit
            if old:
                break
            rank = word

    def first(self) -> int:
        """The lowest rank that waits, or -1."""
        at = min(self.levels[2], default=-1)  # one word for up to 2**18 ranks
        if at >= 0:
            for level in reversed(self.levels):
                word = level[at]
                at = (at << 6) | ((word & -word).bit_length() - 1)
        return at

    def take(self, rank: int) -> np.ndarray:
        """Empties the rank's bucket and clears its bit."""
        taken = self.buckets.pop(rank)
        for level in self.levels:
            word = rank >> 6
            left = level[word] & ~(1 << (rank & 63))
            if left:
                level[word] = left
                break
            del level[word]
            rank = word
        return taken[0] if len(taken) == 1 else np.concatenate(taken)

    def file(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Pushes each position into the bucket of its rank; ranks below 0 are no merge."""
        if not (good := ranks >= 0).all():
            ranks, positions = ranks[good], positions[good]
        if len(ranks):
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for rank, a, b in zip(ranks[starts[:-1]].tolist(), starts, starts[1:], strict=False):
                self.push(rank, positions[a:b])


class Merges:
    """The merge table of a vocabulary: for two tokens, the rank of their concatenation."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs, self.strict = {}, set()
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
                # When the merge that makes such a part happens, a pair of lower rank may appear beside it.
                self.strict.update(part for part in (left, right) if part is not None and part > rank)
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], -1)


class PlaceQueue:
    """Positions of one pre-token waiting by rank, the leftmost first; the same bitmap over the buckets."""

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[dict[int, int]] = [{}, {}, {}]

    def push(self, rank: int, position: int) -> None:
        waiting = self.buckets.get(rank)
        if waiting is not None:
            heappush(waiting, position)
            return
        self.buckets[rank] = [position]
        for level in self.levels:
            word = rank >> 6
            old = level.get(word, 0)
            level[word] = old | 1 << (rank & 63)
            if old:
                break
            rank = word

    def pop(self) -> tuple[int, int]:
        """The lowest rank that waits and its leftmost position; (-1, 0) if none does."""
        at = min(self.levels[2], default=-1)
        if at < 0:
            return -1, 0
        for level in reversed(self.levels):
            word = level[at]
            at = (at << 6) | ((word & -word).bit_length() - 1)
        rank, waiting = at, self.buckets[at]
        position = heappop(waiting)
        if not waiting:
            del self.buckets[rank]
            for level in self.levels:
                word = at >> 6
                left = level[word] & ~(1 << (at & 63))
                if left:
                    level[word] = left
                    break
                del level[word]
                at = word
        return rank, position


def merged(tokens: list[int], merges: Merges) -> list[int]:
    """A pre-token's ids from the tokens it has so far: one merge after the other, each in logarithmic time."""
    find, n = merges.pairs.get, len(tokens)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    queue = PlaceQueue()
    for at in range(n - 1):
        rank = find(tokens[at] << 20 | tokens[at + 1])
        if rank is not None:
            queue.push(rank, at)
    while True:
        rank, at = queue.pop()
        if rank < 0:
            break
        right = after[at]
        if tokens[at] < 0 or right < 0 or find(tokens[at] << 20 | tokens[right]) != rank:
            continue
        tokens[at], tokens[right] = rank, -1
        after[at] = beyond = after[right]
        if beyond >= 0:
            before[beyond] = at
            own = find(rank << 20 | tokens[beyond])
            if own is not None:
                queue.push(own, at)
        left = before[at]
        if left >= 0:
            own = find(tokens[left] << 20 | rank)
            if own is not None:
                queue.push(own, left)
    return [t for t in tokens if t >= 0]


def leftmost_runs(positions: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of sorted positions whose pairs may overlap (runs of one token), those that merge from the left."""
    overlaps = np.zeros(len(positions), bool)
    overlaps[1:] = after[positions[:-1]] == positions[1:]
    if not overlaps.any():
        return positions
    at = np.arange(len(positions))
    start = np.maximum.accumulate(np.where(overlaps, 0, at))
    return positions[(at - start) % 2 == 0]


def encode_many(pieces: list[bytes], merges: Merges) -> list[bytes]:
    """The ids of each pre-token as bytes of little-endian 32-bit numbers."""
    ranks = merges.ranks
    out = [None if (whole := ranks.get(p)) is None else whole.to_bytes(4, "little") for p in pieces]
    todo = [i for i, x in enumerate(out) if x is None]
    if not todo:
        return out
    raw = b"".join([pieces[i] for i in todo])
    n = len(raw)
    token = np.full(n + 1, -1, np.int32)
    token[:n] = merges.single[np.frombuffer(raw, np.uint8)]
    lengths = np.array([len(pieces[i]) for i in todo])
    piece = np.repeat(np.arange(len(todo), dtype=np.int32), lengths)
    ends = np.cumsum(lengths)
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    after[ends - 1] = n  # place n stands for the end of a pre-token
    before[ends[:-1]] = n
    before[0] = n
    starts, alone = ends - lengths, {}
    queue, live = RankQueue(), np.ones(n + 1, bool)
    inner = np.flatnonzero(after[:n] < n).astype(np.int32)
    queue.file(merges.rank(token[inner], token[after[inner]]), inner)
    while (rank := queue.first()) >= 0:
        at = queue.take(rank)
        at = at[live[at]]
        right = after[at]
        at = at[(right < n) & (merges.rank(token[at], token[right]) == rank)]
        at.sort()
        if not len(at):
            continue
        fresh = np.ones(len(at), bool)
        np.not_equal(at[1:], at[:-1], out=fresh[1:])
        at = at[fresh]
        if rank in merges.strict:  # one merge of a pre-token at a time, as a lower rank may come up
            first = np.ones(len(at), bool)
            first[1:] = piece[at[1:]] != piece[at[:-1]]
            if len(at) - np.count_nonzero(first) >= MANY:
                crowded, held = np.unique(piece[at], return_counts=True)
                for k in crowded[held > MANY].tolist():  # many such places: the pre-token goes on by itself
                    own = starts[k] + np.flatnonzero(live[starts[k] : ends[k]])
                    alone[k] = np.array(merged(token[own].tolist(), merges), "<u4").tobytes()
                    live[own] = False
                stay = live[at]
                at, first = at[stay], first[stay]
                if not len(at):
                    continue
            if not first.all():
                queue.push(rank, at[~first])
            at = at[first]
        else:
            at = leftmost_runs(at, after)
        gone = after[at]
        token[at], live[gone] = rank, False
        after[at] = after[gone]
        before[after[at]] = at
        right, left = after[at], before[at]
        here = right < n
        queue.file(merges.rank(token[at[here]], token[right[here]]), at[here])
        here = left < n
        queue.file(merges.rank(token[left[here]], token[at[here]]), left[here])
    keep = np.flatnonzero(live[:n])
    ids = token[keep].astype("<u4").tobytes()
    bounds = (4 * np.searchsorted(keep, np.concatenate([[0], ends]))).tolist()
    for k, i in enumerate(todo):
        out[i] = alone.get(k) or ids[bounds[k] : bounds[k + 1]]
    return out


def is_mixed(text: str) -> bool:
    """Whether a space follows white space somewhere."""
    return any(map(text.__contains__, MIXED_ASCII if text.isascii() else MIXED))


def cut(text: str, mixed: bool) -> list[str]:
    """Chunks, without the space that each but the first begins with."""
    if not mixed:
        return text.split(" ")
    first, *rest = BEFORE_SPACE.split(text)
    return [first, *[x[1:] for x in rest]]


class Chunks:
    """Cuts texts before spaces that follow a non-space, and keeps what was made of chunks met before.

    `encode` turns a list of strings into bytes for each, such that those of two chunks in a row are those of the text:
    no pre-token spans two chunks. The memo has two generations of half of `most_bytes`; chunks that aren't met again
    go with the older one. A task makes its own, so nothing outlives the task. Chunks over `longest` aren't kept.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most_bytes: int = MEMO_BYTES, longest: int = 64, slab: int = 400_000, chars: int = CUT_CHARS):
        self.encode, self.most_bytes, self.longest, self.slab, self.chars = encode, most_bytes, longest, slab, chars
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def encoded(self, values: list[str]) -> Iterator[bytes]:
        """The encoded form of each text; texts are cut a few megabytes at a time, at most a text more."""
        held, size = [], 0
        for text in values:
            held.append(text)
            size += len(text)
            if size >= self.chars:
                yield from self.of(held)
                held, size = [], 0
        if held:
            yield from self.of(held)

    def of(self, values: list[str]) -> Iterator[bytes]:
        pieces = [cut(text, is_mixed(text)) for text in values]
        need: set[str] = set()
        for own in pieces:
            need.update(own[1:])
        need -= self.memo.keys()
        added = {x: self.older[x] for x in need & self.older.keys()}
        new = list(need - added.keys())
        del need
        firsts = self.encode([*[own[0] for own in pieces], *[" " + x for x in new[: self.slab]]])
        added.update(zip(new, firsts[len(pieces) :], strict=False))
        for i in range(self.slab, len(new), self.slab):
            some = new[i : i + self.slab]
            added.update(zip(some, self.encode([" " + x for x in some]), strict=True))
        self.memo.update(added)
        find = self.memo.__getitem__
        for own, first in zip(pieces, firsts, strict=False):
            yield first + b"".join(map(find, own[1:]))
        for x in new:
            if len(x) > self.longest:
                del self.memo[x], added[x]
        self.size += sum(map(len, added)) + sum(map(len, added.values())) + ENTRY * len(added)
        if self.size > self.most_bytes // 2:
            self.older, self.memo, self.size = self.memo, {}, 0


def splitter(pattern: str) -> Callable[[list[str]], tuple[list[str], list[tuple[int, int]]]]:
    """The pre-tokens of all chunks as one list, and where those of each chunk begin and end in it.

    Chunks that begin with a space and don't end with white space may follow each other in a text, where no pre-token spans
    two of them: they are split as one string. Should a pattern not end a pre-token with each chunk, each is split alone.
    No list is made for each chunk: Python's collector would go through them again and again.
    """
    find = regex.compile(pattern).findall

    def split(chunks: list[str]) -> tuple[list[str], list[tuple[int, int]]]:
        inner = [i for i, c in enumerate(chunks) if c[:1] == " " and not c[-1].isspace()]
        some = [chunks[i] for i in inner]
        flat = find("".join(some))
        ends, bounds = (np.cumsum(np.fromiter(map(len, x), np.int64, len(x))) for x in (flat, some))
        last = np.searchsorted(ends, bounds)
        if some and (not len(ends) or last[-1] == len(ends) or (ends[last] != bounds).any()):
            inner, flat, last = [], [], last[:0]
        begin, end, alone = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64), np.ones(len(chunks), bool)
        end[inner], alone[inner] = last + 1, False
        begin[inner[1:]] = last[:-1] + 1
        for i in np.flatnonzero(alone).tolist():
            begin[i] = len(flat)
            flat += find(chunks[i])
            end[i] = len(flat)
        return flat, list(zip(begin.tolist(), end.tolist(), strict=True))

    return split


@lru_cache(1)
def merges_of(path: str) -> Merges:
    """The merge table, which depends on the file only; kept while the worker lives."""
    return Merges(load_ranks(path))


def encoder(path: str, pattern: str) -> Callable[[list[str]], list[bytes]]:
    """Ids of strings by the rank file at `path`, each match of `pattern` by itself, as little-endian 32-bit numbers."""
    merges, split = merges_of(path), splitter(pattern)

    def encode(chunks: list[str]) -> list[bytes]:
        flat, spans = split(chunks)
        pieces = list(set(flat))
        ids = dict(zip(pieces, encode_many([p.encode() for p in pieces], merges), strict=True))
        found = list(map(ids.__getitem__, flat))
        return [found[a] if b == a + 1 else b"".join(found[a:b]) for a, b in spans]

    return encode


def decode(ids, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


def token_table(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digest_only: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (array of int) and decoded (binary) of every text; no shuffle.

    Null and empty texts have no ids. With `digest_only`, ids and decoded are replaced by ids_sha256 (of the decimal
    ids joined by commas) and decoded_sha256, made where the ids are, so that they needn't leave the task. `path` must
    be readable on every executor, as the tokenizer files are. Equal rows give equal results; the document's other
    columns are not carried.
    """

    def each():
        chunks, tokens = Chunks(encoder(path, pattern), chars=QUEUE_CHARS), token_table(path)
        decimal = [str(i) for i in range(len(tokens))]

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_out, bytes_out = [], [], []
            for packed in chunks.encoded(texts(batch, text_col)):
                raw = np.frombuffer(packed, "<u4")
                ids = raw.tolist()
                back = decode(ids, tokens)
                n.append(len(ids))
                if digest_only:
                    ids_out.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    bytes_out.append(hashlib.sha256(back).hexdigest())
                else:
                    ids_out.append(raw.astype(np.int32))
                    bytes_out.append(back)
            last = [pa.array(ids_out, pa.string()), pa.array(bytes_out, pa.string())] if digest_only else [pa.array(ids_out, pa.list_(pa.int32())), pa.array(bytes_out, pa.binary())]
            return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(n, pa.int64()), *last], names)

        return turn

    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest_only else ["ids", "decoded"])]
    kinds = "ids_sha256 string, decoded_sha256 string" if digest_only else "ids array<int>, decoded binary"
    return arrow_pass(docs.select(id_col, text_col), each, f"doc_id long, n_tokens long, {kinds}")
