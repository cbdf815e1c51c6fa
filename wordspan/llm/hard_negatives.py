"""Hard negatives by a vertical scan of columnar vectors.

Vectors are whole numbers, held dimension by dimension. An anchor reads the dimensions in the order of its own largest
magnitudes. After every few of them, what the dimensions left can still add, at least and at most over the block, bounds
each candidate's score from both sides; candidates that no window can hold any more leave the bitmap. One scan finds an
anchor's positives, whose scores set the windows; a second finds the best of every window.

Blocks of rows meet blocks of anchors, each pair in a task of its own, so memory is that of two blocks whatever the
labels are; a task returns a few rows for each anchor. Work is in proportion to rows times anchors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordspan.llm.common import stage

#: Rows and anchors of a block; dimensions between two looks at the bounds.
BLOCK, ANCHORS, STEP = 8192, 1024, 8
#: Components beyond it count as it: the sums of 2048 dimensions still fit in 64 bits.
MOST = 1 << 25
#: What is left of a bitmap when the columns are made shorter.
SHRUNK = 0.75


def usable(vector: Column) -> Column:
    """Not null, and no null or non-finite component."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component x as double, -MOST to MOST."""
    return F.transform(vector, lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(x.cast("double") * scale))).cast("int"))


def matrix(lists: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Dimensions as rows; vectors that are shorter count as followed by zeros."""
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.asarray(lists.combine_chunks().value_lengths()))])
    values, n = np.asarray(lists.combine_chunks().flatten(), np.int64), len(at) - 1
    if (np.diff(at) == dims).all():
        return np.ascontiguousarray(values.reshape(n, dims).T)
    out, row = np.zeros((dims, n), np.int64), np.repeat(np.arange(n), np.diff(at))
    out[np.arange(len(values)) - at[row], row] = values
    return out


def scan(anchor: np.ndarray, columns: np.ndarray, least: np.ndarray, most: np.ndarray, rows: np.ndarray, ids: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each closed window of scores, the k best of `rows` (places in columns) in it and their scores.

    least, most: of every dimension over the block. Higher scores come first, ties by the smaller id. Exact.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[: np.count_nonzero(anchor)]
    ends = np.stack([anchor[order] * least[order], anchor[order] * most[order]])
    below, above = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (ends.min(0), ends.max(0)))
    held, score, alive = columns[:, rows], np.zeros(len(rows), np.int64), np.ones(len(rows), bool)
    for a in range(0, len(order), STEP):
        dims = order[a : a + STEP]
        score += anchor[dims] @ held[dims]
        b = min(a + STEP, len(order))
        low, high = score + below[b], score + above[b]
        may = np.zeros(len(rows), bool)
        for lo, hi in windows:
            inside = alive & (high >= lo) & (low <= hi)
            sure = low[inside & (low >= lo) & (high <= hi)]
            if len(sure) > k:  # k are at least that good, and a tie may win by its id
                inside &= high >= np.partition(sure, -k)[-k]
            may |= inside
        alive &= may
        left = np.count_nonzero(alive)
        if not left:
            break
        if left < SHRUNK * len(rows):
            held, score, rows, alive = held[:, alive], score[alive], rows[alive], np.ones(left, bool)
    out = []
    for lo, hi in windows:
        at = np.flatnonzero(alive & (score >= lo) & (score <= hi))
        at = at[np.lexsort((ids[rows[at]], -score[at]))[:k]]
        out.append((rows[at], score[at]))
    return out


FOUND = {"anchor_row": pa.int64(), "anchor_id": pa.int64(), "k": pa.int32(), "positive_id": pa.int64(), "positive_score": pa.int64(), "id": pa.int64(), "score": pa.int64()}


def searcher(same: bool, most: int, bounds: Callable[[int], tuple[int, int]]):
    """A task's work: the rows of a block against the anchors of another, of the anchor's label or of others."""

    def run(_: tuple, both: pa.Table) -> pa.Table:
        asks = both.filter(both.column("is_anchor"))
        given = both.filter(pa.compute.invert(both.column("is_anchor")))
        out: list[tuple] = []
        if asks.num_rows and given.num_rows:
            dims = max(pa.compute.max(pa.compute.list_value_length(both.column("v"))).as_py(), 1)
            columns, anchors = matrix(given.column("v"), dims), matrix(asks.column("v"), dims)
            least, high = columns.min(1), columns.max(1)
            ids, labels = (np.asarray(given.column(c)) for c in ("id", "label"))
            for n, ask in enumerate(asks.drop_columns(["v", "is_anchor"]).to_pylist()):
                fits = (labels == ask["label"]) == same
                rows = np.flatnonzero(fits & (ids != ask["id"]))
                asked = [(k, p["id"], p["score"]) for k, p in enumerate(ask["positives"] or [])] if not same else [(0, None, None)]
                windows = [(-np.inf, np.inf) if same else bounds(p) for _, _, p in asked]
                for (k, p, ps), (at, score) in zip(asked, scan(anchors[:, n], columns, least, high, rows, ids, windows, most) if len(rows) else [], strict=False):
                    out += [(ask["row"], ask["id"], k, p, ps, i, s) for i, s in zip(ids[at].tolist(), score.tolist(), strict=True)]
        return pa.table([pa.array([x[c] for x in out], t) for c, t in enumerate(FOUND.values())], names=list(FOUND))

    return run


def best(found: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first rows of each group over all blocks, with their rank from 1; tasks keep only those before they are sent."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= most)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the hard negatives of every anchor.

    A component x counts as floor(scale * x); components beyond 2**25 in magnitude count as 2**25. A score is the inner
    product with the anchor. `anchors` says of the given rows which are anchors. An anchor's positives are its best rows
    of the same label, as many as `positives`; a positive's negatives are the best rows of other labels whose score is
    from `low` to `high` hundredths of the positive's. Ties go to the smaller id. All rows are searched, exactly.

    Rows with a null id, a null label, a null vector, or a null or non-finite component take no part. A vector shorter
    than another counts as followed by zeros; one without components scores 0. Each row of an id that repeats is an
    anchor and a candidate of its own, but no partner of its own id. Other columns are not looked at.
    """
    named = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    held = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    rows = stage(held.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole(F.col("v"), scale).alias("v"), "asks"))
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks, groups = max(1, -(-n // BLOCK)), max(1, -(-asking // ANCHORS))
    dealt = lambda seed, parts: F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(parts)).cast("int")
    upto = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")
    given = rows.select(dealt("block", blocks).alias("i"), upto(groups).alias("j"), F.lit(False).alias("is_anchor"), "row", "id", "label", "v", none.alias("positives"))
    own = rows.where("asks").select("row", "id", "label", "v")

    def search(asks: DataFrame, same: bool, most: int) -> DataFrame:
        sent = asks.select(upto(blocks).alias("i"), dealt("anchor", groups).alias("j"), F.lit(True).alias("is_anchor"), "row", "id", "label", "v", "positives")
        work = searcher(same, most, lambda p: (-(-low * p // 100), high * p // 100))
        return given.unionByName(sent).groupBy("i", "j").applyInArrow(work, "anchor_row long, anchor_id long, k int, positive_id long, positive_score long, id long, score long")

    near = best(search(own.withColumn("positives", none), True, positives), ["anchor_row"], positives)
    listed = stage(near.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p")))
    with_positives = own.join(listed, own["row"] == listed["anchor_row"]).select("row", "id", "label", "v", F.transform("p", lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score"))).alias("positives"))
    far = best(search(with_positives, False, negatives), ["anchor_row", "k"], negatives)
    return far.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
