"""Exact duplicates by minimal perfect hashes over the distinct digests of earlier loads.

Digests of history are grouped, dealt into shards by digest, and each shard gets a minimal perfect hash: a pilot for
every bucket of keys, and slots that hold the full digest and its winner's locator. Groups of the incoming load look
their digest up there; only a byte-for-byte match counts as a member. Members merge with the slot's winner, the rest
form groups of their own. The index is a table with one row a shard: nothing of it goes through the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordspan.functions.names import free
from wordspan.llm.common import SPACES, arrow_pass, shuffle_width, stage, texts

#: Keys a bucket of the perfect hash holds on average, and digests a shard has when there are many.
BUCKET, SHARD = 4, 4096
#: Stands in groups for the winner's id where all of the longest rows have a null id: any id wins over it.
NO_ID = (1 << 63) - 1
GROUP = "shard int, digest binary, keep_id long, keep_len long, group_size long"


def words_of(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 4)


#: Low bits of a product that don't count: where n is a power of two, they come again after few pilots, and two keys may
#: then never find two free places. And how many pilots a bucket is given; equal keys, which can't be, would need more.
LOW, MOST_TRIES = np.uint64(33), 1 << 26


def position(keys: np.ndarray, pilot: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((keys[:, 2] + pilot * (keys[:, 3] | np.uint64(1))) >> LOW) % np.uint64(n)).astype(np.int64)


def build(keys: np.ndarray) -> np.ndarray:
    """Pilots of a minimal perfect hash of n distinct keys onto 0..n-1: largest buckets first, smallest pilot that fits."""
    n = len(keys)
    bucket = (keys[:, 1] % np.uint64(n // BUCKET + 1)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(n // BUCKET + 2))
    pilots, taken = np.zeros(n // BUCKET + 1, np.uint64), np.zeros(n, bool)
    for b in np.argsort(-np.diff(starts), kind="stable"):
        own = keys[order[starts[b] : starts[b + 1]]]
        if not len(own):
            break
        base, width = 0, 64
        while True:
            tries = np.arange(base, base + width, dtype=np.uint64)
            with np.errstate(over="ignore"):
                at = (((own[:, 2] + tries[:, None] * (own[:, 3] | np.uint64(1))) >> LOW) % np.uint64(n)).astype(np.int64)
            fits = ~taken[at].any(axis=1)
            if len(own) > 1:
                in_order = np.sort(at, axis=1)
                fits &= (in_order[:, 1:] != in_order[:, :-1]).all(axis=1)
            if fits.any():
                pick = int(np.argmax(fits))
                pilots[b] = tries[pick]
                taken[at[pick]] = True
                break
            base, width = base + width, min(4 * width, 8192)
            if base > MOST_TRIES:
                raise ValueError("no perfect hash: keys repeat")
    return pilots


def sealed(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """Pilots, slots (full digests in order) and the groups in the order of their slots."""
    keys = words_of(list(pdf["digest"]))
    pilots = build(keys)
    order = np.argsort(position(keys, pilots[(keys[:, 1] % np.uint64(len(pilots))).astype(np.int64)], len(keys)))
    return pilots, keys[order], pdf.iloc[order].reset_index(drop=True)


def merged(new: pd.DataFrame, pilots: np.ndarray, slots: np.ndarray, old: pd.DataFrame) -> pd.DataFrame:
    """Looks the new groups up: members join their slot's group, whose winner may change; the others stand apart."""
    if not len(new):
        return old
    keys = words_of(list(new["digest"]))
    at = position(keys, pilots[(keys[:, 1] % np.uint64(len(pilots))).astype(np.int64)], len(slots))
    member = (slots[at] == keys).all(axis=1)  # all 32 bytes
    hit, at = new[member], at[member]
    keep_id, keep_len, size = (old[c].to_numpy(np.int64).copy() for c in ("keep_id", "keep_len", "group_size"))
    new_id, new_len = hit["keep_id"].to_numpy(np.int64), hit["keep_len"].to_numpy(np.int64)
    wins = (new_len > keep_len[at]) | ((new_len == keep_len[at]) & (new_id < keep_id[at]))
    keep_id[at[wins]], keep_len[at[wins]] = new_id[wins], new_len[wins]
    size[at] += hit["group_size"].to_numpy(np.int64)
    return pd.concat([old.assign(keep_id=keep_id, keep_len=keep_len, group_size=size), new[~member]], ignore_index=True)


def index_of(groups: DataFrame) -> DataFrame:
    """An index to keep for later loads: one row a shard, with pilots, and slots in order with digest and winner."""

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pilots, slots, old = sealed(pdf)
        columns = {c: [old[c].to_numpy(np.int64).tobytes()] for c in ("keep_id", "keep_len", "group_size")}
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "pilots": [pilots.tobytes()], "slots": [slots.tobytes()], **columns})

    return groups.groupBy("shard").applyInPandas(make, "shard int, pilots binary, slots binary, keep_id binary, keep_len binary, group_size binary")


def look_up(groups: DataFrame, index: DataFrame) -> DataFrame:
    """Merges a later load's groups, dealt into as many shards, with an index: a row for each slot and each other group."""

    def merge(new: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        if row.empty:
            return new
        row = row.iloc[0]
        raw = row["slots"]
        slots = np.frombuffer(raw, "<u8").reshape(-1, 4)
        old = pd.DataFrame({"shard": row["shard"], "digest": [raw[i : i + 32] for i in range(0, len(raw), 32)], **{c: np.frombuffer(row[c], "<i8") for c in ("keep_id", "keep_len", "group_size")}})
        return merged(new, np.frombuffer(row["pilots"], "<u8"), slots, old)

    return groups.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(merge, GROUP)


def look_up_within(groups: DataFrame) -> DataFrame:
    """The same where both loads are at hand (column old): each shard's index is built and used in one task."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        old, new = pdf[pdf["old"]].drop(columns="old"), pdf[~pdf["old"]].drop(columns="old")
        return merged(new, *sealed(old)) if len(old) else new

    return groups.groupBy("shard").applyInPandas(merge, GROUP)


def grouped(rows: DataFrame, shards: int) -> DataFrame:
    """A row for each load and distinct digest with its winner (most code points, then smallest id), dealt into shards."""
    best = F.max(F.struct(F.col("n_points").alias("l"), (-F.col("doc_id")).alias("i")))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    made = rows.groupBy("digest", "old").agg(best.alias("b"), F.count("*").alias("group_size"))
    return made.select(shard.alias("shard"), "digest", F.coalesce(-F.col("b.i"), F.lit(NO_ID)).alias("keep_id"), F.col("b.l").alias("keep_len"), "group_size", "old")


def exact_dedup(docs: DataFrame, is_history: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    `is_history` marks the rows of the earlier load, whose distinct digests the index holds; by default those are half
    of the rows by a hash of the id. The rows that stay do not depend on it. Null texts count as empty, empty texts
    form one group, rows with the same id and text each count and are both kept, an empty table gives no rows. A null id
    counts in its group and is kept by none (kept is null); keep_id is null where all of the longest rows have null ids.
    """
    return compared(docs, is_history, id_col, text_col).select("doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def longest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all columns, of the document that each group of equal texts keeps.

    Rows with a null id stay if they are among the longest of a group and none of those has an id.
    """
    found = compared(docs, None, id_col, text_col).where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("doc_id").isNotNull() | (F.col("n_points") == F.col("keep_len"))))
    own_id, digest, n = free(docs.columns, "id", "digest", "n")
    kept = found.select(F.col("doc_id").alias(own_id), F.col("digest").alias(digest), F.col("n_points").alias(n)).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.unhex(F.sha2(F.translate(text, SPACES, "").cast("binary"), 256))
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (bare == F.col(digest)) & (F.length(text).cast("long") == F.col(n))
    return docs.join(kept, same, "left_semi")


def compared(docs: DataFrame, is_history: Column | None, id_col: str, text_col: str) -> DataFrame:
    """A row for each row: doc_id, n_points, digest, and its group's keep_id, keep_len and group_size."""
    spark = docs.sparkSession
    is_history = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2)) == 0 if is_history is None else is_history
    made = stage(digests(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(is_history, F.lit(False)).alias("old"))))
    shards = max(2 * shuffle_width(spark), -(-made.count() // SHARD))
    found = look_up_within(grouped(made, shards)).select("digest", F.nullif("keep_id", F.lit(NO_ID)).alias("keep_id"), "keep_len", "group_size")
    return made.join(found, "digest").select("doc_id", "n_points", "digest", "keep_id", "keep_len", "group_size")


def digests(marked: DataFrame) -> DataFrame:
    """doc_id, n_points (code points of the text), digest (SHA-256 of the text without white space), old, of rows (doc_id, text, old)."""

    def each():
        spaces = SPACES.encode()

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = texts(batch)
            found = [hashlib.sha256(t.encode().translate(None, spaces)).digest() for t in values]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, values), pa.int64()), pa.array(found, pa.binary()), batch.column("old")], ["doc_id", "n_points", "digest", "old"])

        return turn

    return arrow_pass(marked, each, "doc_id long, n_points long, digest binary, old boolean")
