"""Random word windows: around label boundaries, and of texts of one class. Narrow plans: a row's windows are worked
out within the row, and the words are only cut for the windows that are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordspan.functions.labels import boundaries
from wordspan.functions.once import once
from wordspan.functions.rng import draw, heads
from wordspan.functions.text import has_words, join_words, tokens
from wordspan.operators.dataset import shuffled
from wordspan.sources import ordered_files
from wordspan.sources.staging import staged

#: Attempts for each window that is wanted.
ATTEMPTS = 6


def boundary_spans(n: Column, bounds: Column, key: Column, seed: int, least: int, most: int, copies: int) -> Column:
    """Up to `copies` distinct spans (s, e) that cover a boundary, in the order of the attempts that gave them.

    An attempt picks a boundary and a span around it. What is longer than `most` is trimmed a word at a time at an end
    drawn by a coin, the boundary staying inside, which has the closed form below; what is shorter than `least` grows
    by turns to the left and right as far as the text goes.
    """
    longest = max(most, 2)
    tries = F.transform(F.sequence(F.lit(0), F.lit(ATTEMPTS * copies - 1)), lambda a: F.struct(a.alias("a"), F.get(bounds, draw(seed, key, a, "b", below=F.size(bounds)).cast("int")).alias("b")))
    drawn = F.transform(tries, lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), draw(seed, key, t["a"], "s", below=t["b"] + 1).cast("int").alias("s"), (t["b"] + 2 + draw(seed, key, t["a"], "e", below=n - t["b"] - 1)).cast("int").alias("e")))
    counted = F.transform(drawn, lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["s"].alias("s"), t["e"].alias("e"), F.greatest(F.lit(0), t["e"] - t["s"] - longest).alias("k")))
    tossed = F.transform(counted, lambda t: F.struct(t["b"].alias("b"), t["s"].alias("s"), t["e"].alias("e"), t["k"].alias("k"), F.least(F.greatest(heads(t["k"], seed, key, t["a"], "h"), t["k"] - (t["e"] - t["b"] - 2)), t["b"] - t["s"]).alias("ds")))
    trimmed = F.transform(tossed, lambda t: F.struct((t["s"] + t["ds"]).alias("s"), (t["e"] - t["k"] + t["ds"]).alias("e")))
    lacking = F.transform(trimmed, lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"), (least - t["e"] + t["s"]).alias("d")))
    left = lambda t: F.least(t["s"], F.greatest(F.ceil(t["d"] / 2).cast("int"), t["d"] - (n - t["e"])))
    grown = F.transform(F.filter(lacking, lambda t: (t["d"] <= 0) | (t["s"] + n - t["e"] >= t["d"])), lambda t: F.when(t["d"] <= 0, F.struct(t["s"].alias("s"), t["e"].alias("e"))).otherwise(F.struct((t["s"] - left(t)).alias("s"), (t["e"] + t["d"] - left(t)).alias("e"))))
    fitting = F.filter(grown, lambda t: (t["e"] - t["s"] >= least) & (t["e"] - t["s"] <= longest))
    return F.slice(F.array_distinct(fitting), 1, copies)


def boundary_windows(samples: DataFrame, seed: int, id_col: str, least: int = 35, most: int = 350, copies: int = 10, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """id, copy, s, e, text, label: windows of samples whose words and labels agree and that have a boundary."""
    words = once(samples, w=tokens(F.col(text_col)), l=F.col(label_col)).select(id_col, "w", "l")
    parsed = once(words.where((F.size("w") == F.size("l")) & (F.size("l") >= 2)), bounds=boundaries(F.col("l")), n=F.size("w")).where(F.size("bounds") > 0)
    spans = boundary_spans(F.col("n"), F.col("bounds"), F.col(id_col), seed, least, most, copies)
    out = once(parsed, spans=spans).select(id_col, "w", "l", F.posexplode("spans").alias("copy", "t"))
    width = F.col("t.e") - F.col("t.s")
    return out.select(id_col, "copy", F.col("t.s").alias("s"), F.col("t.e").alias("e"), join_words(F.slice("w", F.col("t.s") + 1, width)).alias("text"), F.slice("l", F.col("t.s") + 1, width).alias("label"))


def one_class_windows(docs: DataFrame, seed: int, id_col: str, label: int, least: int = 35, most: int = 350, copies: int = 8, text_col: str = "text") -> DataFrame:
    """id, copy, s, e, text, label: `copies` windows of each text of `least` words or more; equal windows all stay."""
    words = once(docs, w=tokens(F.col(text_col))).select(id_col, "w").where(F.size("w") >= least)
    key, n = F.col(id_col), F.size("w")
    size = lambda k: (least + draw(seed, key, k, "n", below=F.least(F.lit(most), n) - least + 1)).cast("int")
    sized = F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), lambda k: F.struct(k.alias("k"), size(k).alias("n")))
    placed = F.transform(sized, lambda t: F.struct(draw(seed, key, t["k"], "s", below=n - t["n"] + 1).cast("int").alias("s"), t["n"].alias("n")))
    out = once(words, spans=placed).select(id_col, "w", F.posexplode("spans").alias("copy", "t"))
    return out.select(id_col, "copy", F.col("t.s").alias("s"), (F.col("t.s") + F.col("t.n")).alias("e"), join_words(F.slice("w", F.col("t.s") + 1, F.col("t.n"))).alias("text"), F.array_repeat(F.lit(label), F.col("t.n")).alias("label"))


def to_target(docs: DataFrame, seed: int, id_col: str, label: int, target: int, least: int = 35, most: int = 350, copies: int = 8, text_col: str = "text") -> DataFrame:
    """The first `target` of the one-class windows of all texts, sources in an order that the seed decides.

    Only ids are put in order; windows are cut for the sources that the target takes, and no others.
    """
    ids = staged(docs.where(has_words(F.col(text_col), least)).select(id_col))
    takes = shuffled(ids, seed, [id_col]).where(F.col("pos") * copies < target)
    chosen = docs.join(takes, id_col)
    cut = one_class_windows(chosen.select(id_col, text_col), seed, id_col, label, least, most, copies, text_col)
    return cut.join(takes, id_col).where(F.col("pos") * copies + F.col("copy") < target).drop("pos")


def yields(sources: DataFrame, windows: DataFrame, id_col: str, copies: int) -> DataFrame:
    """sources, windows, wanted (copies of each source), yield_pct and skipped (sources without a window)."""
    made = windows.groupBy(id_col).agg(F.count("*").alias("windows"))
    each = sources.select(id_col).join(made, id_col, "left")
    out = each.agg(F.count("*").alias("sources"), F.coalesce(F.sum("windows"), F.lit(0)).alias("windows"), F.count_if(F.col("windows").isNull()).alias("skipped"))
    return out.withColumn("wanted", F.col("sources") * copies).withColumn("yield_pct", F.coalesce(F.try_divide(100.0 * F.col("windows"), F.col("wanted")), F.lit(0.0)))


def stream_to_target(spark: SparkSession, path: str, base: str, seed: int, id_col: str, label: int, target: int, schema: str, per_trigger: int = 1, least: int = 35, most: int = 350, copies: int = 8) -> DataFrame:
    """`target` one-class windows, or all there are, of texts in a store of folders; folders that aren't needed aren't opened.

    Folders come in an order that the seed decides, `per_trigger` at a time. Of the batch that reaches the target the
    windows that a hash of seed, id and copy puts first are kept, so the result is the same each time. `base` is a new
    folder for the windows and the state of the stream. `schema` has the id and text.
    """
    out = f"{base}/windows"
    shape = one_class_windows(spark.createDataFrame([], schema), seed, id_col, label, least, most, copies).schema
    found = [0]

    def take(batch: DataFrame, number: int) -> None:
        made = staged(one_class_windows(batch, seed, id_col, label, least, most, copies))
        n, left = made.count(), target - found[0]
        if n > left:
            made = shuffled(made, seed, [id_col, "copy"]).where(F.col("pos") < left).drop("pos")
        made.write.mode("overwrite").parquet(f"{out}/batch={number}")
        found[0] += min(n, left)
        if found[0] >= target:
            spark.range(1).write.mode("overwrite").parquet(f"{base}/enough")

    spark.createDataFrame([], shape).write.parquet(f"{out}/batch=none")
    texts = ordered_files.stream(spark, path, f"{base}/enough", seed, schema, per_trigger)
    query = texts.writeStream.foreachBatch(take).option("checkpointLocation", f"{base}/state").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(shape).parquet(f"{out}/*")
