"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors of a label are one class from the start. The trees of a label grow level by level on all its classes: a
pass sums up the projections of every leaf that is too large on a few random directions, the leaf splits at the mean of
the widest, and vectors within a margin of the split go down both sides. No vector reaches the driver, only counts and
sums by leaf. Every class is sent to its leaves in every tree and compared there in double precision. A pair that meets
in several leaves counts in the first only, so a task returns a row for each vector, not for each pair: its links found
there and one link to its local component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordspan.llm.common import arrow_pass, stage
from wordspan.llm.components import components

#: Trees of a label, classes a leaf should have at most, random directions that a leaf chooses from, directions in all.
TREES, LEAF, TRIES, POOL = 5, 32, 4, 256
#: Nodes of the forest at most, 24 bytes each: it is broadcast. Beyond that, leaves stay larger.
MOST_NODES = 1 << 20
#: Vectors of a block; leaves with more are compared in pairs of blocks.
BLOCK = 2000
#: The spill margin, and the least spread of a leaf that is worth a split, in standard deviations of the projected
#: difference of two unit vectors that just link. A leaf below it is one cluster: most of its pairs link.
SPILL, NARROW = 0.5, 2.0
#: A leaf that three splits in a row leave with most of its classes is not split again.
MOST_OF, STUCK = 0.9, 3


@lru_cache(4)
def pool(dims: int) -> np.ndarray:
    """Random unit vectors as columns, the same on every machine."""
    made = np.random.default_rng([29, dims]).standard_normal((dims, POOL))
    return made / np.linalg.norm(made, axis=0)


@dataclass
class Forest:
    """Nodes as arrays: direction (-1 for leaves), split, children, classes (-1: not counted yet), margin."""

    roots: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    direction: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int16))
    split: np.ndarray = field(default_factory=lambda: np.zeros(0))
    low: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    before: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    stuck: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int8))

    def add(self, n: int, before: np.ndarray, stuck: np.ndarray) -> np.ndarray:
        """New leaves, to be counted; children of a node are neighbours."""
        first = len(self.direction)
        new = {"direction": np.full(n, -1, np.int16), "split": np.zeros(n), "low": np.zeros(n, np.int32), "count": np.full(n, -1, np.int64), "before": before, "stuck": stuck}
        for name, values in new.items():
            setattr(self, name, np.concatenate([getattr(self, name), values]))
        return np.arange(first, first + n)

    def places(self, at: np.ndarray, roots: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for rows with projections `at` and roots; rows near a split go both ways."""
        rows, nodes, found = np.repeat(np.arange(len(roots)), roots.shape[1]), roots.ravel(), []
        while len(rows):
            inner = self.direction[nodes] >= 0
            found.append((rows[~inner], nodes[~inner]))
            rows, nodes = rows[inner], nodes[inner]
            off = at[rows, self.direction[nodes]] - self.split[nodes]
            down, up = off <= margin, off > -margin
            rows, nodes = np.concatenate([rows[down], rows[up]]), np.concatenate([self.low[nodes[down]], self.low[nodes[up]] + 1])
        rows, nodes = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((nodes, rows))
        return rows[order], nodes[order]

    def candidates(self, nodes: np.ndarray) -> np.ndarray:
        """Columns of the pool that each leaf tries."""
        code = (nodes[:, None].astype(np.uint64) * np.uint64(TRIES) + np.arange(TRIES, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return (code >> np.uint64(40)) % np.uint64(POOL)


def deviation(dims: int, threshold: float) -> float:
    """Standard deviation of the projected difference of two unit vectors that just link."""
    return float(np.sqrt((2 - 2 * threshold) / dims))


def usable(vector: str, label: str) -> Column:
    """Rows that can link: a label, and a vector of finite numbers that isn't zero or empty."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(label).isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def projected(batch: pa.RecordBatch, forest: Forest) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each number of dimensions: it, the rows of labels with trees, their projections and roots."""
    labels, sizes = batch.column("label").to_pylist(), batch.column("dims").to_pylist()
    rows_of: dict[int, list[int]] = {}
    for r, key in enumerate(zip(labels, sizes, strict=True)):
        if key in forest.roots:
            rows_of.setdefault(key[1], []).append(r)
    for dims, rows in rows_of.items():
        x = unit(np.asarray(batch.column("vector").take(pa.array(rows)).flatten()).reshape(len(rows), dims))
        yield dims, np.array(rows), x @ pool(dims), np.stack([forest.roots[labels[r], dims] for r in rows])


def surveyed(members: DataFrame, forest: Forest, threshold: float) -> pd.DataFrame:
    """node, n, and sums and sums of squares on each candidate direction, of the leaves not counted yet."""
    sent = members.sparkSession.sparkContext.broadcast(forest)
    sums = [f"{c}{k}" for c in ("s", "q") for k in range(TRIES)]

    def each():
        forest = sent.value

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, total = np.zeros(len(forest.direction)), np.zeros((2 * TRIES, len(forest.direction)))
            for dims, _, at, roots in projected(batch, forest):
                rows, nodes = forest.places(at, roots, SPILL * deviation(dims, threshold))
                open_ = forest.count[nodes] < 0
                rows, nodes = rows[open_], nodes[open_]
                n += np.bincount(nodes, minlength=len(n))
                for k, column in enumerate(forest.candidates(nodes).T):
                    off = at[rows, column]
                    total[k] += np.bincount(nodes, off, len(n))
                    total[TRIES + k] += np.bincount(nodes, off * off, len(n))
            met = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([pa.array(met), pa.array(n[met].astype(np.int64)), *(pa.array(row[met]) for row in total)], ["node", "n", *sums])

        return turn

    found = arrow_pass(members.select("label", "dims", "vector"), each, f"node long, n long, {', '.join(f'{c} double' for c in sums)}")
    return found.groupBy("node").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in sums)).toPandas().sort_values("node", ignore_index=True)


def grown(members: DataFrame, large: list, threshold: float) -> Forest:
    """Trees over all classes of the large labels (label, dims, n), a pass over the vectors for each level."""
    forest = Forest()
    for label, dims, _ in large:
        forest.roots[label, dims] = forest.add(TREES, np.zeros(TREES, np.int64), np.zeros(TREES, np.int8))
    owner = {int(root): key[1] for key, roots in forest.roots.items() for root in roots}
    spread = np.array([deviation(owner[k], threshold) for k in range(len(forest.direction))])
    while len(forest.count) and (forest.count < 0).any():
        table = surveyed(members, forest, threshold)
        forest.count[forest.count < 0] = 0
        node, n = table["node"].to_numpy(), table["n"].to_numpy()
        forest.count[node] = n
        grew = n > MOST_OF * forest.before[node]
        forest.stuck[node] = np.where(grew & (forest.before[node] > 0), forest.stuck[node] + 1, 0)
        mean, square = (table[[f"{c}{k}" for k in range(TRIES)]].to_numpy() / n[:, None] for c in ("s", "q"))
        wide = np.sqrt(np.maximum(square - mean * mean, 0))
        best = wide.argmax(axis=1)
        at = np.arange(len(node))
        worth = (n > LEAF) & (wide[at, best] > NARROW * spread[node]) & (forest.stuck[node] < STUCK)
        # the largest leaves split first where the forest is full
        room = (MOST_NODES - len(forest.count)) // 2
        chosen = np.sort(np.flatnonzero(worth)[np.argsort(-n[worth], kind="stable")][: max(0, room)])
        if not len(chosen):
            break
        parent = node[chosen]
        forest.direction[parent] = forest.candidates(parent)[np.arange(len(chosen)), best[chosen]]
        forest.split[parent] = mean[chosen, best[chosen]]
        new = forest.add(2 * len(chosen), np.repeat(n[chosen], 2), np.repeat(forest.stuck[parent], 2))
        forest.low[parent] = new[::2]
        spread = np.concatenate([spread, np.repeat(spread[parent], 2)])
    return forest


def route(members: DataFrame, forest: Forest, threshold: float) -> DataFrame:
    """label, dims, cid, size, vector, leaves and their numbers of blocks; a label without trees has the one leaf -1."""
    sent = members.sparkSession.sparkContext.broadcast(forest)

    def each():
        forest = sent.value
        blocks = np.maximum(1, -(-forest.count // BLOCK))

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            leaves, parts = [[-1]] * batch.num_rows, [[1]] * batch.num_rows
            for dims, own, at, roots in projected(batch, forest):
                rows, nodes = forest.places(at, roots, SPILL * deviation(dims, threshold))
                cuts = np.searchsorted(rows, np.arange(1, len(own)))
                for r, found in zip(own.tolist(), np.split(nodes, cuts), strict=True):
                    leaves[r], parts[r] = found.tolist(), blocks[found].tolist()
            ints = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, ints), pa.array(parts, ints)], [*batch.schema.names, "leaves", "blocks"])

        return turn

    return arrow_pass(members, each, f"label long, dims int, cid long, size long, vector {dict(members.dtypes)['vector']}, leaves array<int>, blocks array<int>")


def compare(threshold: float):
    def work(key, pdf: pd.DataFrame) -> pd.DataFrame:
        leaf, i, j = int(key[2]), int(key[3]), int(key[4])
        pdf = pdf.sort_values("cid", ignore_index=True)
        n, x, size, block = len(pdf), unit(pdf["vector"]), pdf["size"].to_numpy(), pdf["block"].to_numpy()
        earlier = [[v for v in leaves if v < leaf] for leaves in pdf["leaves"]]
        names = {v: k for k, v in enumerate(sorted({v for own in earlier for v in own}))}
        met = np.zeros((n, len(names)), np.float32)
        for r, own in enumerate(earlier):
            met[r, [names[v] for v in own]] = 1
        links, root = np.zeros(n, np.int64), np.arange(n)
        a, b = (np.flatnonzero(block == i), np.flatnonzero(block == j))
        near = []
        for start in range(0, len(a), 512):
            rows = a[start : start + 512]
            linked = x[rows] @ x[b].T >= threshold
            if i == j:
                linked &= rows[:, None] < b[None, :]
            new = linked & (met[rows] @ met[b].T == 0)
            links[rows] += new @ size[b]
            links[b] += size[rows] @ new
            near.append((rows, np.packbits(linked, axis=1)))
        moved = True
        while moved:  # smallest place reachable, by passing minima along links and jumping to the root's root
            old = root.copy()
            for rows, bits in near:
                linked = np.unpackbits(bits, axis=1, count=len(b)).astype(bool)
                least = np.minimum(root[rows], np.where(linked, root[b], n).min(axis=1, initial=n))
                root[b] = np.minimum(root[b], np.where(linked, least[:, None], n).min(axis=0, initial=n))
                root[rows] = np.minimum(root[rows], least)
            root = root[root]
            moved = bool((old != root).any())
        cid = pdf["cid"].to_numpy()
        keep = (links > 0) | (root != np.arange(n))
        return pd.DataFrame({"cid": cid[keep], "links": links[keep], "root": cid[root[keep]]})

    return work


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """A row for each row: vec_id, n_links, component_id, kept.

    Vectors are compared if their labels are equal and not null and they have as many dimensions. Null, empty and zero
    vectors and those with null or non-finite components link with nothing. A row given twice counts as two vectors,
    linked with each other; vectors whose copies all have null ids link with those copies only. Pairs at or over the threshold are found unless split in
    all trees; none below it is linked. Labels of up to LEAF classes have no trees: all their pairs are compared. A leaf
    that can't be split (a cluster narrower than the spill margin) is compared in pairs of blocks. An empty table gives
    no rows; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"), usable(vector_col, label_col).alias("ok"))
    same = ["label", "hash", "vector"]
    good = rows.where("ok").withColumn("hash", F.xxhash64("vector"))
    classes = stage(good.groupBy(*same).agg(F.min("vec_id").alias("cid"), F.count("*").alias("size")))
    members = classes.where("cid IS NOT NULL").select("label", F.size("vector").alias("dims"), "cid", "size", "vector")
    sizes = members.groupBy("label", "dims").agg(F.count("*").alias("n")).where(F.col("n") > LEAF)
    most = MOST_NODES // (4 * TREES)
    large = sizes.orderBy(F.desc("n"), "label", "dims").limit(most).collect()
    forest = grown(members, large, threshold)

    routed = stage(route(members, forest, threshold))
    cell = ["label", "dims", "leaf"]
    dealt = routed.select("*", F.explode(F.arrays_zip("leaves", "blocks")).alias("z")).select(*routed.drop("blocks").columns, F.col("z.leaves").alias("leaf"), F.col("z.blocks").alias("blocks"))
    if len(large) == most:  # labels beyond the room for roots are leaves of their own
        rest = sizes.select("label", "dims", F.lit(-1).alias("leaf"), F.ceil(F.col("n") / BLOCK).cast("int").alias("more"))
        dealt = dealt.join(rest, cell, "left").withColumn("blocks", F.greatest("blocks", F.coalesce("more", F.lit(1)))).drop("more")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(23), "cid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    found = stage(pairs.select(*cell, "i", "j", "block", "cid", "size", "vector", "leaves").groupBy(*cell, "i", "j").applyInPandas(compare(threshold), "cid long, links long, root long"))

    joined = components(found, "cid", "root").select(F.col("a").alias("cid"), F.col("b").alias("component_id"))
    linked = found.groupBy("cid").agg(F.sum("links").alias("links")).join(joined, "cid", "full")
    known = classes.join(linked, "cid", "left").select(*same, (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component_id", "cid").alias("component_id"))
    out = good.join(known, same).select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
