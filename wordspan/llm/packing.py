"""Best-fit packing of token sequences with a bounded number of open bins.

Documents are tokenized once into thin rows (a piece's place and length). Pieces are dealt into groups by a hash; in
each group they arrive longest first and go to the open bin they fit best. The open bins stand in a bitset keyed by free
space; when all are in use and none fits, the fullest closes. What is still open with room at the end of a group is
packed again with that of other groups, in ever fewer groups, so groups cost next to nothing in sequences.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache
from itertools import chain, compress, count, pairwise

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordspan.llm.bpe import Chunks
from wordspan.llm.common import arrow_pass, stage, texts

#: Open bins of a group, and pieces a group has in a round.
OPEN_BINS, GROUP_ROWS = 1024, 4096
#: A bin at the end of a group is not packed again when less than this share of it is free.
GOOD = 0.01
PLACED = "number long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: number tells pieces of the staged table apart: ids may be repeated or null.
PIECE = "number long, doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(1)
def library_tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # their strings are ordinary text
    return made


#: Chunks that are encoded as one string, and characters of those that may be.
JOINED, SHORT = 2048, 4096
#: What a byte-level pre-tokenizer cuts texts by.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of() -> dict[str, int]:
    """The byte that a character of a byte-level token stands for: itself where it can be seen, else 256 and on by turns."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(c): b for b, c in [*zip(seen, seen, strict=True), *((b, 256 + k) for k, b in enumerate(hidden))]}


@lru_cache(1)
def ranked(path: str) -> tiktoken.Encoding | None:
    """The same vocabulary by ranks, many times as fast; None unless it is a plain byte-level BPE whose ids are its ranks."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    model, cuts = given["model"], given["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or given["normalizer"] or cuts.get("type") != "ByteLevel" or not cuts.get("use_regex", True) or cuts.get("add_prefix_space"):
        return None
    vocab, bytes_of = model["vocab"], byte_of()
    special = {t["content"] for t in given["added_tokens"]}
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    tokens = [t for t in vocab if t not in special]
    first = [t for t in tokens if len(t) == 1]
    if len(first) != 256 or len(tokens) != 256 + len(made) or [vocab[t] for t in made] != list(range(256, 256 + len(made))) or not set("".join(tokens)) <= bytes_of.keys():
        return None
    return tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL, mergeable_ranks={bytes(bytes_of[c] for c in t): vocab[t] for t in tokens}, special_tokens={})


def library_chunks(path: str) -> Chunks:
    """Chunks encoded without special tokens, as the tokenizers library does.

    Where the vocabulary allows it, chunks that begin with a space and don't end with white space are encoded as one
    string, as no pre-token spans two of them; the lengths of the tokens' bytes say where each chunk's ids end.
    """
    tokenizer, ranks = library_tokenizer(path), ranked(path)

    def alone(chunks: list[str]) -> list[bytes]:
        ids = [e.ids for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        raw = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
        ends = np.cumsum([0, *map(len, ids)]) * 4
        return [raw[a:b] for a, b in pairwise(ends.tolist())]

    if ranks is None:
        return Chunks(alone, slab=8192)
    size = np.array([len(ranks.decode_single_token_bytes(i)) for i in range(ranks.n_vocab)], np.int64)

    def together(chunks: list[str]) -> list[bytes]:
        ids = np.array(ranks.encode_ordinary("".join(chunks)), "<u4")
        ends, bounds = np.cumsum(size[ids]), np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks])
        raw, at = ids.tobytes(), (4 * (np.searchsorted(ends, bounds) + 1)).tolist()
        return [raw[a:b] for a, b in pairwise([0, *at])]

    def encode(chunks: list[str]) -> list[bytes]:
        joins = [c[:1] == " " and len(c) <= SHORT and not c[-1].isspace() for c in chunks]
        own = list(compress(chunks, joins))
        out = [x for i in range(0, len(own), JOINED) for x in together(own[i : i + JOINED])]
        if len(own) == len(chunks):
            return out
        by = {True: iter(out), False: iter(alone([c for c, j in zip(chunks, joins, strict=True) if not j]))}
        return [next(by[j]) for j in joins]

    return Chunks(encode)


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of `most` tokens but the first, which has the rest."""
    count = max(1, -(-n // most))
    first = n - most * (count - 1)
    return [(0, first), *((first + most * i, most) for i in range(count - 1))]


def pieces_of(docs: DataFrame, tokenizer: str, most: int, end_id: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    def each():
        chunks, end = library_chunks(tokenizer), int(end_id).to_bytes(4, "little")
        numbers = count(TaskContext.get().partitionId() << 40)

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, ids = [], []
            for doc, raw in zip(batch.column(id_col).to_pylist(), chunks.encoded(texts(batch, text_col)), strict=True):
                raw += end
                for k, (start, length) in enumerate(cut(len(raw) // 4, most)):
                    part = raw[4 * start : 4 * (start + length)]
                    rows.append((next(numbers), doc, k, start, length, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])], names)

        return turn

    names = ["number", "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return arrow_pass(docs.select(id_col, text_col), each, PIECE + (", ids array<int>" if with_ids else ""))


def best_fit(lengths: list[int], most: int, open_bins: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each length in order of arrival, and the bins still open at the end.

    Bit f of `spaces` is set while some open bin has f tokens free: the best fit for a length is the first set bit from
    it on. A full bin closes at once.
    """
    spaces, by_space, n_open, made = 0, {}, 0, 0
    bins, offsets = [], []
    for length in lengths:
        fitting = spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            own = by_space[free]
            at = own.pop()
            if not own:
                del by_space[free]
                spaces &= ~(1 << free)
            n_open -= 1
        else:
            if n_open == open_bins:
                fullest = (spaces & -spaces).bit_length() - 1
                own = by_space[fullest]
                own.pop()
                if not own:
                    del by_space[fullest]
                    spaces &= ~(1 << fullest)
                n_open -= 1
            at, made, free = made, made + 1, most
        bins.append(at)
        offsets.append(most - free)
        if left := free - length:
            by_space.setdefault(left, []).append(at)
            spaces |= 1 << left
            n_open += 1
    return bins, offsets, [b for free, own in by_space.items() if free > GOOD * most for b in own]


def placer(turn: int, last: bool, most: int, open_bins: int):
    """Packs one group; in all rounds but the last, pieces of bins left open get sequence_id -1."""

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("order", "ascending"), ("number", "ascending")])
        bins, offsets, still_open = best_fit(group.column("length").to_pylist(), most, open_bins)
        bins = np.array(bins)
        # 5 bits of round, 34 of group, 24 of bin
        ids = ((turn << 58) | (group.column("bin_group")[0].as_py() << 24)) + bins
        if not last:
            ids[np.isin(bins, still_open)] = -1
        out = group.select(["number", "doc_id", "piece", "start", "length", "ids_crc32"])
        return out.append_column("sequence_id", pa.array(ids, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return place


def pack(pieces: DataFrame, most: int, open_bins: int, group_rows: int) -> DataFrame:
    """Places pieces that are shorter than `most`: rows of PLACED, with sequence ids from 0 for each round and group."""
    placed, waiting, n, turn = [], pieces, pieces.count(), 0
    while n:
        groups, last = -(-n // group_rows), n <= group_rows
        order = F.xxhash64(F.lit(turn), "number")
        dealt = waiting.withColumns({"order": order, "bin_group": F.pmod(order, F.lit(groups))})
        done = stage(dealt.groupBy("bin_group").applyInArrow(placer(turn, last, most, open_bins), PLACED))
        placed.append(done.where("sequence_id >= 0"))
        waiting = done.where("sequence_id < 0").drop("sequence_id", "offset")
        left = 0 if last else waiting.count()
        group_rows *= 1 if left < 0.7 * n else 2
        n, turn = left, turn + 1
    out = placed[0] if placed else pieces.sparkSession.createDataFrame([], PLACED)
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, most: int = 2048, end_id: int = 0, open_bins: int = OPEN_BINS, group_rows: int = GROUP_ROWS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    Null and empty texts are one piece that holds only the end token. Sequence ids are any distinct numbers. Repeated
    rows are packed each; null ids are carried; an empty table gives no rows.
    """
    made = stage(pieces_of(docs, tokenizer, most, end_id, id_col, text_col, with_ids))
    thin = made.drop("ids")
    whole = thin.where(F.col("length") == most).withColumns({"sequence_id": -1 - F.col("number"), "offset": F.lit(0).cast("long")})
    out = whole.unionByName(pack(thin.where(F.col("length") < most), most, open_bins, group_rows))
    return (out.join(made.select("number", "ids"), "number") if with_ids else out).drop("number")
