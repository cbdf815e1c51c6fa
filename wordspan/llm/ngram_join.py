"""Exact similarity join of documents on word n-grams, in the metric space of the Jaccard distance.

Equal sets are one node. A set's prefix in a global order of n-grams (rare ones first) meets the prefix of every set
within the distance, so nodes are within reach of each other only if they share a cell, the nodes of one prefix
n-gram. The smallest node of a cell is its pivot, and a node's Voronoi region is that of the nearest pivot among its
cells'. Distances to pivots are exact: nodes within the distance link to their pivot; the others are compared with
each other and with those covered nodes that the triangle inequality leaves in reach. Cells that span regions give
pairs of regions, whose boundary nodes, again by the triangle inequality, are sent to the pair and compared. A region,
or pair, with too much to compare is joined recursively: new pivots are drawn from it, its nodes go to the nearest and,
as boundary nodes, to all that the triangle inequality leaves in reach. Only links that connectivity needs are returned.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordspan.llm.common import arrow_pass, commonest, stage, texts
from wordspan.llm.components import components

#: Words of an n-gram; the threshold as a fraction.
WORDS, NEAR, WHOLE = 5, 80, 100
DISTANCE = 1 - NEAR / WHOLE
#: N-grams whose frequency the global order knows (any order is exact), bits of the id filter, nodes of a block.
MOST_FREQUENT, FILTER_BITS, BLOCK = 1 << 18, 1 << 25, 1000
STEP = np.uint64(0x9E3779B97F4A7C15)
SLACK = 1e-9
#: Pivots drawn from a region that is joined recursively, and how far the comparisons must fall for its split to stand.
PIVOTS, WORTH = 8, 0.9
#: A set's prefix has 1/LONGER of its n-grams more than needed: two sets within the distance, n and m in size, then share
#: 1 + min(n, m) // LONGER cells or more.
LONGER = 10


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit codes of the n-grams of the words of the text, A-Z lower-cased."""
    code = np.fromiter(map(xxhash.xxh64_intdigest, text.encode().lower().split()), np.uint64)
    if not len(code):
        return code
    n = min(words, len(code))
    out = np.full(len(code) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out ^ code[i : i + len(out)]) * STEP
            out ^= out >> np.uint64(31)
    return np.unique(out)


def signed(codes: np.ndarray) -> np.ndarray:
    return codes.view(np.int64)


def digest(codes: np.ndarray) -> bytes:
    return hashlib.blake2b(codes.tobytes(), digest_size=16).digest()


def surveyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of kind 0: id, set size and digest; rows of kind 1: n-grams that several sets of a batch share, and how many."""

    def each():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = list(map(shingles, texts(batch, text_col)))
            made = [digest(s) for s in sets]
            halves = np.frombuffer(b"".join(made), np.int64).reshape(-1, 2)
            code, n = np.unique(np.concatenate(list(dict(zip(made, sets, strict=True)).values())), return_counts=True)
            code, n = signed(code[n > 1]), n[n > 1]
            zeros = np.zeros(len(code), np.int64)
            kind = np.concatenate([np.zeros(len(sets), np.int32), np.ones(len(code), np.int32)])
            ids = pa.chunked_array([batch.column(id_col).cast(pa.int64()), pa.array(code)]).combine_chunks()
            n = np.concatenate([np.array(list(map(len, sets)), np.int64), n])
            return pa.RecordBatch.from_arrays([pa.array(kind), ids, pa.array(n), *(pa.array(np.concatenate([halves[:, k], zeros])) for k in (0, 1))], ["kind", "id", "n", "high", "low"])

        return turn

    return arrow_pass(docs.select(id_col, text_col), each, "kind int, id long, n long, high long, low long")


def prefixes(docs: DataFrame, order, id_col: str, text_col: str) -> DataFrame:
    """cell, id: each n-gram of a document's prefix; equal sets of a batch are taken once."""

    def each():
        codes, rank = order.value

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen, cells, ids = set(), [], []
            for doc, text in zip(batch.column(id_col).to_pylist(), texts(batch, text_col), strict=True):
                s = shingles(text)
                if not len(s) or (d := digest(s)) in seen:
                    continue
                seen.add(d)
                n = len(s)
                at = np.minimum(np.searchsorted(codes, signed(s)), max(0, len(codes) - 1))
                known = np.where(codes[at] == signed(s), rank[at], 0) if len(codes) else np.zeros(n)
                cells.append(signed(s[np.lexsort((s, known))[: n - -(-NEAR * n // WHOLE) + 1 + n // LONGER]]))
                ids.append(np.full(len(cells[-1]), doc, np.int64))
            none = [np.zeros(0, np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells or none)), pa.array(np.concatenate(ids or none))], ["cell", "id"])

        return turn

    return arrow_pass(docs.select(id_col, text_col), each, "cell long, id long")


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that holds every id (by hash) and few others."""
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = ids.groupBy(F.shiftright(bit, 5).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(31)).cast("int"))).alias("bits"))
    out = np.zeros(FILTER_BITS >> 5, np.int64)
    rows = words.toPandas()
    out[rows["word"].to_numpy(int)] = rows["bits"].to_numpy(np.int64)
    return out.astype(np.uint32)


def sets_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, codes: the sets of the documents that `ids` names, as packed sorted codes."""
    sent = docs.sparkSession.sparkContext.broadcast(id_filter(ids))

    def each():
        bits = sent.value

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            bit = batch.column("bit").to_numpy()
            rows = np.flatnonzero(bits[bit >> 5] >> (bit & 31).astype(np.uint32) & 1)
            some = batch.take(pa.array(rows))
            return pa.RecordBatch.from_arrays([some.column("id"), pa.array([shingles(t).tobytes() for t in texts(some, text_col)], pa.binary())], ["id", "codes"])

        return turn

    given = docs.select(F.col(id_col).cast("long").alias("id"), text_col)
    return arrow_pass(given.withColumn("bit", F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))), each, "id long, codes binary").join(ids, "id", "left_semi")


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """x, p, d, near for each pair x, p."""

    def each():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            d, near = [], []
            for a, b in zip(batch.column("xs").to_pylist(), batch.column("ps").to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                d.append(1 - both / (len(a) + len(b) - both))
                near.append(WHOLE * both >= NEAR * (len(a) + len(b) - both))
            return pa.RecordBatch.from_arrays([batch.column("x"), batch.column("p"), pa.array(d), pa.array(near)], ["x", "p", "d", "near"])

        return turn

    both = pairs.select("x", "p").join(sets.select(F.col("id").alias("x"), F.col("codes").alias("xs")), "x").join(sets.select(F.col("id").alias("p"), F.col("codes").alias("ps")), "p")
    return arrow_pass(both.select("x", "p", "xs", "ps"), each, "x long, p long, d double, near boolean")


def linker(across: bool):
    """Links within a group of nodes: those of side 0 with those of side 1 and, unless `across`, with each other.

    A pair counts where one of the two is at home (core). A group holds one block or two; with two, only pairs of one
    from each are looked at. An inverted index over the
    group's sets gives a node's intersections with all others at once. Pairs that earlier links connect are left out.
    """

    def work(key, pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[-2]), int(key[-1])
        pdf = pdf.sort_values("x", ignore_index=True)
        sets = [np.frombuffer(c, np.uint64) for c in pdf["codes"]]
        size, side, block, own = np.array(list(map(len, sets))), pdf["side"].to_numpy(), pdf["block"].to_numpy(), pdf["x"].to_numpy()
        core = pdf["core"].to_numpy()
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        root, found = np.arange(len(sets)), []
        for x in np.flatnonzero(side == 0):
            start, end = np.searchsorted(flat, sets[x], "left"), np.searchsorted(flat, sets[x], "right")
            spans = end - start
            at = np.repeat(start - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            ok = WHOLE * both >= NEAR * (size[x] + size - both)
            ok &= (block == (j if block[x] == i else i)) & (root != root[x]) & (core | core[x])
            for y in np.flatnonzero(ok & (side == 1) if across else ok):
                if root[x] != root[y]:
                    found.append((own[x], own[y]))
                    root[root == root[y]] = root[x]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return work


def to_compare(across: bool) -> Column:
    """The comparisons of a region, over its rows."""
    apart, other = F.count_if(F.col("side") == 0), F.count_if(F.col("side") == 1)
    return apart * (other if across else F.count("*"))


def divided(rows: DataFrame, sets: DataFrame, group: list[str], across: bool) -> DataFrame:
    """Rows (group, x, side) with part and core: regions with over BLOCK * BLOCK comparisons are cut around new pivots.

    A node goes to its nearest pivot, where it is core if it was before, and to every part whose core nodes it may be
    within the distance of: by the triangle inequality its distance from each pivot is within the window that those
    nodes' distances span, widened by the join's distance, and no more than twice that farther than its nearest pivot.
    A region stays whole where its parts would have nearly as much to compare; `compared` cuts it into blocks.
    """
    whole = [*group, "part"]
    todo = rows.select(*group, F.lit(0).cast("long").alias("part"), "x", "side", F.lit(True).alias("core"))
    done, level = [], 0
    while True:
        work = todo.groupBy(*whole).agg(to_compare(across).alias("work"), F.count("*").alias("n")).where(F.col("work") > BLOCK * BLOCK)
        large = stage(work)
        if large.isEmpty():
            return reduce(DataFrame.unionByName, done, todo)
        done.append(todo.join(large, whole, "left_anti"))
        open_ = stage(todo.join(large, whole))
        drawn = F.pmod(F.xxhash64(F.lit(37 + level), "x"), F.col("n")) < PIVOTS
        pivots = open_.where(drawn & F.col("core")).select(*whole, F.col("x").alias("pivot")).distinct()
        pairs = stage(open_.join(pivots, whole))
        near = distances(pairs.select("x", F.col("pivot").alias("p")).distinct(), sets).select("x", F.col("p").alias("pivot"), "d")
        near = pairs.join(near, ["x", "pivot"]).groupBy(*whole, "x").agg(F.sort_array(F.collect_list(F.struct("pivot", "d"))).alias("ds"), F.min(F.struct("d", "pivot")).alias("home"), *(F.first(c).alias(c) for c in ("side", "core", "work")))
        near = stage(near)
        # the distances from every pivot that the core nodes of a part have
        spans = near.where("core").select(*whole, F.col("home.pivot").alias("at"), F.explode("ds").alias("e")).groupBy(*whole, "at", F.col("e.pivot").alias("pivot")).agg(F.min("e.d").alias("least"), F.max("e.d").alias("most"))
        windows = spans.groupBy(*whole, "at").agg(F.sort_array(F.collect_list(F.struct("pivot", "least", "most"))).alias("window"))
        inside = F.forall(F.zip_with("ds", "window", lambda d, w: d["d"].between(w["least"] - DISTANCE - SLACK, w["most"] + DISTANCE + SLACK)), lambda ok: ok)
        to_it = F.filter("ds", lambda d: d["pivot"] == F.col("at"))[0]["d"]
        placed = near.join(windows, whole).where(inside & (to_it <= F.col("home.d") + 2 * DISTANCE + SLACK))
        placed = stage(placed.select(*whole, F.xxhash64("part", "at", F.lit(level)).alias("new"), "x", "side", (F.col("core") & (F.col("at") == F.col("home.pivot"))).alias("core"), "work"))
        parts = placed.groupBy(*whole, "new").agg(to_compare(across).alias("own"), F.first("work").alias("work"))
        good = stage(parts.groupBy(*whole).agg(F.sum("own").alias("own"), F.first("work").alias("work")).where(F.col("own") < WORTH * F.col("work")).select(*whole))
        done.append(open_.join(good, whole, "left_anti").select(*whole, "x", "side", "core"))
        todo = placed.join(good, whole, "left_semi").select(*group, F.col("new").alias("part"), "x", "side", "core")
        level += 1


def dealt(rows: DataFrame, group: list[str], across: bool) -> DataFrame:
    """The rows of each group by block, and in the pairs of blocks i, j in which they are compared.

    A group of up to BLOCK rows is one block. In a larger one each side has blocks of its own, and only those meet that
    have pairs to compare: rows of side 0 go to each block of side 1 and, unless `across`, of side 0, rows of side 1 to
    each block of side 0. A large side that meets a few rows is thus sent once.
    """
    one, side = F.col("n0") + F.col("n1") <= BLOCK, F.col("side") == 0
    counts = rows.groupBy(*group).agg(F.count_if(side).alias("n0"), F.count_if(~side).alias("n1"))
    counts = counts.withColumn("own", F.when(one, 1).otherwise(F.ceil(F.col("n0") / BLOCK)).cast("int"))
    counts = counts.select(*group, one.alias("one"), "own", F.when(one, 1).otherwise(F.col("own") + F.ceil(F.col("n1") / BLOCK)).cast("int").alias("blocks"))
    hashed, rest = F.xxhash64(F.lit(31), "x"), F.greatest(F.lit(1), F.col("blocks") - F.col("own"))
    block = F.when(F.col("one") | side, F.pmod(hashed, F.greatest(F.lit(1), "own"))).otherwise(F.col("own") + F.pmod(hashed, rest)).cast("int")
    meets = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.col("one") | F.when(side, o >= F.col("own") if across else F.lit(True)).otherwise(o < F.col("own")))
    both = rows.join(counts, group).withColumn("block", block).withColumn("other", F.explode(meets)).drop("one", "own", "blocks")
    return both.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")


def compared(rows: DataFrame, sets: DataFrame, group: list[str], across: bool) -> DataFrame:
    """a, b: links among the rows (group, x, side) of each group, by parts and blocks."""
    cut, group = stage(divided(stage(rows), sets, group, across)), [*group, "part"]
    full = dealt(cut, group, across).join(sets.select(F.col("id").alias("x"), "codes"), "x")
    return full.groupBy(*group, "i", "j").applyInPandas(linker(across), "a long, b long")


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: doc_id, n_shingles, component_id.

    Documents link if the Jaccard similarity of their sets of word 5-grams is at least 0.8. With fewer than five words
    the whole sequence is the one n-gram; null, empty and blank texts have empty sets and link with nothing. Copies of a
    set share its component. N-grams are told apart by 64-bit codes. Rows with the same id are one document for links.
    """
    spark = docs.sparkSession
    first = stage(surveyed(docs, id_col, text_col))
    thin = first.where("kind = 0").select("id", "n", "high", "low")
    frequent = commonest(first.where("kind = 1").groupBy(F.col("id").alias("code")).agg(F.sum("n").alias("n")).where("n > 2"), MOST_FREQUENT)
    order = spark.sparkContext.broadcast((frequent["code"].to_numpy(np.int64), np.log2(frequent["n"].to_numpy(float)).astype(int)))
    same = ["high", "low", "n"]
    classes = thin.where("n > 0").groupBy(*same).agg(F.min("id").alias("node"))
    node_of = stage(thin.join(classes, same).select("id", "node", "n"))

    cell = Window.partitionBy("cell")
    spread = prefixes(docs, order, id_col, text_col).withColumns({"least": F.min("id").over(cell), "most": F.max("id").over(cell)})
    cells = stage(stage(spread.where("least < most").select("cell", "id")).join(node_of, "id").select("cell", "node", "n").distinct())
    for _ in range(2):  # a node's partner has four fifths of its n-grams at least
        shared = cells.join(cells.groupBy("cell").agg(F.count("*").alias("m")).where("m > 1").select("cell"), "cell", "left_semi")
        enough = shared.groupBy("node", "n").agg(F.count("*").alias("m")).where(F.col("m") > F.floor(F.col("n") * NEAR / WHOLE / LONGER))
        cells = stage(shared.join(enough.select("node"), "node", "left_semi"))
    pivots = cells.groupBy("cell").agg(F.min("node").alias("p"), F.max("node").alias("last")).where("p < last").drop("last")
    cells = stage(cells.join(pivots, "cell").select("cell", F.col("node").alias("x"), "n", "p"))
    sets = stage(sets_of(docs, cells.select(F.col("x").alias("id")).distinct(), id_col, text_col))

    # Regions: the nearest pivot of a node's cells. A node that is the pivot of all its cells is its own.
    met = cells.where("x <> p").select("x", "p").distinct()
    home = F.min(F.struct("d", "p", "near")).alias("m")
    members = stage(distances(met, sets).groupBy("x").agg(home).select("x", "m.p", "m.d", "m.near"))
    links = members.where("near").select(F.col("x").alias("a"), F.col("p").alias("b"))
    reach = members.where("not near").groupBy("p").agg(F.min("d").alias("from"))
    window = members.join(reach, "p").where(~F.col("near") | (F.col("d") >= F.col("from") - DISTANCE - SLACK))
    inner = window.select("p", "x", F.col("near").cast("int").alias("side"))
    links = stage(links.unionByName(compared(inner, sets, ["p"], across=False)))

    # Cells that still span regions and components give pairs of regions; their boundaries are compared.
    joined = components(links)
    regions = cells.select("x").distinct().join(members.select("x", F.col("p").alias("r"), "d"), "x", "left").join(joined.select(F.col("a").alias("x"), F.col("b").alias("c")), "x", "left")
    regions = regions.select("x", F.coalesce("r", "x").alias("r"), F.coalesce("d", F.lit(0.0)).alias("d"), F.coalesce("c", "x").alias("c"))
    placed = cells.select("cell", "x", "n").join(regions, "x")
    spans = placed.groupBy("cell").agg(*[f(k).alias(f"{n}_{k}") for k in ("r", "c") for n, f in (("min", F.min), ("max", F.max))]).where("min_r < max_r and min_c < max_c").select("cell")
    open_cells = stage(placed.join(spans, "cell"))
    width = open_cells.groupBy("r").agg(F.max("d").alias("w"), F.min("n").alias("size"))
    sides = open_cells.select("cell", "r").distinct()
    met = sides.select("cell", F.col("r").alias("x")).join(sides.select("cell", F.col("r").alias("p")), "cell").where("x < p").groupBy("x", "p").agg(F.count("*").alias("m"))
    met = met.join(width.select(F.col("r").alias("x"), F.col("w").alias("wx"), F.col("size").alias("nx")), "x").join(width.select(F.col("r").alias("p"), F.col("w").alias("wp"), F.col("size").alias("np")), "p")
    met = stage(met.where(F.col("m") > F.floor(F.least("nx", "np") / LONGER)).select("x", "p", "wx", "wp"))
    apart = distances(met, sets).select("x", "p", F.col("d").alias("apart"))
    pairs = stage(apart.join(met, ["x", "p"]).where(F.col("apart") <= F.col("wx") + F.col("wp") + DISTANCE + SLACK))
    nodes = open_cells.select("x", "r", "d").distinct()
    left = pairs.select(F.col("x").alias("r"), F.col("p").alias("q"), F.col("wp").alias("w"), "apart", F.lit(True).alias("first"))
    right = pairs.select(F.col("p").alias("r"), F.col("x").alias("q"), F.col("wx").alias("w"), "apart", F.lit(False).alias("first"))
    boundary = nodes.join(left.unionByName(right), "r").where(F.col("apart") <= F.col("d") + F.col("w") + DISTANCE + SLACK)
    outer = boundary.select(F.least("r", "q").alias("p"), F.greatest("r", "q").alias("q"), "x", (~F.col("first")).cast("int").alias("side"))
    links = links.unionByName(compared(outer, sets, ["p", "q"], across=True))

    found = components(links).select(F.col("a").alias("node"), F.col("b").alias("c"))
    named = node_of.join(found, "node", "left").groupBy(F.col("id").alias("doc_id")).agg(F.min(F.coalesce("c", "node")).alias("component_id"))
    sized = thin.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"))
    return sized.join(named, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
