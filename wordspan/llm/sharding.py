"""Sharding by histogram sort (law `bytes`), with DataFrame functions only.

The sort key is (hash of text, hash of id): equal texts are neighbours and any group can still be cut. Rounds of
exact byte counts below candidate key boundaries narrow every splitter's interval by a fixed factor until the bytes
below it are within tolerance; then the rows are exchanged once, with their final shard and slot.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordspan.functions.names import quoted
from wordspan.llm.common import shuffle_width, stage

#: Bits of the key that one round resolves: a round collects at most 2**STEP counts for each open splitter.
STEP = 12
#: The two hashes of the key, each 64 bits, are read as one string of digits of STEP bits; the last digit is short.
DIGITS = [(part, max(0, 64 - STEP * (k + 1)), min(STEP, 64 - STEP * k)) for part in ("__h", "__t") for k in range(-(-64 // STEP))]


def digit(k: int) -> Column:
    part, shift, bits = DIGITS[k]
    at = F.shiftrightunsigned(F.col(part), shift).bitwiseAND(F.lit((1 << bits) - 1))
    return at.cast("int")


def splitters(keys: DataFrame, n_shards: int, tolerance: float, whole_below: float) -> tuple[list[tuple[int, ...]], int]:
    """Key prefixes (tuples of digits) at which shards 1, 2, ... begin, and the number of bytes in all.

    A splitter is final once a boundary lies within `tolerance` of its target, or when its bin is one text whose
    copies hold less than `whole_below` of a shard (then they stay together); else the bin holding the target opens.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    targets = {i: total * i / n_shards for i in range(1, n_shards)}
    open_bins: dict[tuple[int, ...], int] = {(): 0}  # prefix -> bytes below it
    waiting, final = dict.fromkeys(targets, ()), {}
    texts_done = len(DIGITS) // 2
    for k in range(len(DIGITS)):
        if not waiting or not total:
            break
        bins = [digit(j) for j in range(k)]
        path = F.concat_ws(".", *bins) if k else F.lit("")
        counted = keys.withColumn("__path", path)
        if k:
            counted = counted.where(F.col("__path").isin(sorted({".".join(map(str, p)) for p in waiting.values()})))
        rows = counted.groupBy("__path", digit(k).alias("__digit")).agg(F.sum("size").alias("n")).collect()
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for r in rows:
            prefix = tuple(map(int, r["__path"].split("."))) if r["__path"] else ()
            found.setdefault(prefix, []).append((r["__digit"], r["n"]))
        opened = {}
        for i, prefix in list(waiting.items()):
            steps = sorted(found[prefix])
            below = list(accumulate((n for _, n in steps), initial=open_bins[prefix]))
            at = min(max(bisect_right(below, targets[i]) - 1, 0), len(steps) - 1)
            near = at if targets[i] - below[at] <= below[at + 1] - targets[i] else at + 1
            limit = tolerance * total / n_shards
            if k + 1 >= texts_done and steps[at][1] <= whole_below * total / n_shards:
                limit = float("inf")
            if abs(below[near] - targets[i]) <= limit or k + 1 == len(DIGITS):
                final[i] = (*prefix, steps[near][0]) if near < len(steps) else (*prefix, steps[-1][0] + 1)
                del waiting[i]
            else:
                waiting[i] = (*prefix, steps[at][0])
                opened[waiting[i]] = below[at]
        open_bins = opened
    return [final.get(i, ()) for i in range(1, n_shards)], total


def at_or_after(prefix: tuple[int, ...]) -> Column:
    """Whether a row's key is at or after the boundary."""
    out = F.lit(True)
    for k in reversed(range(len(prefix))):
        out = (digit(k) > prefix[k]) | ((digit(k) == prefix[k]) & out)
    return out


def shard_documents(docs: DataFrame, n_shards: int = 8, tolerance: float = 0.002, whole_below: float = 0.02, rows_a_cell: int = 16_384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` with size (UTF-8 bytes plus 1; null: 1), shard and slot (gapless from 0 in each shard).

    Shards have near equal bytes. Equal texts share a shard unless their group holds over `whole_below` of one.
    Rows are numbered in cells of a shard dealt by the hash of the id, so that no task holds a whole shard or group.
    Repeated rows are numbered apart; an empty table gives no rows. Columns of `docs` that are called size, shard or
    slot, in whatever case, are replaced; those of any other name are kept.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot")]
    own = {c: f"c{k}" for k, c in enumerate(dict.fromkeys([*kept, id_col, text_col]))}  # names that none of the columns below has
    key, text = own[id_col], own[text_col]
    plain = docs.select(*(F.col(quoted(c)).alias(n) for c, n in own.items()))
    keyed = plain.withColumns({"size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1, "__h": F.xxhash64(text), "__t": F.xxhash64(F.lit(7), key)})
    keys = stage(keyed.select("__h", "__t", "size"))
    bounds, _ = splitters(keys, n_shards, tolerance, whole_below)
    shard = sum((at_or_after(b).cast("int") for b in bounds if b), F.lit(0))
    n = keys.count()
    cells = max(-(-2 * shuffle_width(spark) // n_shards), -(-n // (n_shards * rows_a_cell)), 1)
    place = {"shard": shard.cast("int"), "__cell": F.pmod(F.shiftright("__t", 20), F.lit(cells)).cast("int")}
    counts = sorted((r["shard"], r["__cell"], r["n"]) for r in keys.withColumns(place).groupBy("shard", "__cell").agg(F.count("*").alias("n")).collect())
    firsts, so_far = [], {}
    for s, c, m in counts:
        firsts.append((s, c, so_far.get(s, 0)))
        so_far[s] = so_far.get(s, 0) + m
    # At most n_shards * cells rows: two for each shuffle partition, or one for rows_a_cell documents.
    offsets = spark.createDataFrame(firsts, "shard int, __cell int, __first long")
    within = Window.partitionBy("shard", "__cell").orderBy("__h", "__t", key, text)
    numbered = keyed.withColumns(place).join(F.broadcast(offsets), ["shard", "__cell"]).withColumn("slot", F.col("__first") + F.row_number().over(within) - 1)
    return numbered.select(*(F.col(own[c]).alias(c) for c in kept), "size", "shard", "slot")
