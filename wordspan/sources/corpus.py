"""Corpus splits: the position of a text among those that survive the filters, and looking texts up by it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordspan.functions.text import has_words, starts_equal
from wordspan.sources.staging import staged

#: Columns that exist within `ranked` only.
BUCKET, FIRST = "__bucket", "__first"


def ranked(df: DataFrame, bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Adds each row's place from 0 in a total order, without sorting in one task.

    `bucket` is an int that never falls as the order rises. Rows are numbered within their bucket; the counts of the
    buckets, a row each, are summed up and added. `bucket` and `order` must not depend on chance. `df` is read twice.
    """
    kept = df.withColumn(BUCKET, bucket)
    sizes = kept.groupBy(BUCKET).agg(F.count("*").alias("n"))
    first = F.sum("n").over(Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select(F.col(BUCKET), F.coalesce(first, F.lit(0)).alias(FIRST))
    within = F.row_number().over(Window.partitionBy(BUCKET).orderBy(*order)) - 1
    return kept.join(firsts, BUCKET).withColumn(name, (F.col(FIRST) + within).cast("long")).drop(BUCKET, FIRST)


def key_bucket(df: DataFrame, key: str, buckets: int) -> Column:
    """Ranges of a key with about as many rows each; a job finds their bounds, one number for each range."""
    shares = [k / buckets for k in range(1, buckets)]
    if not shares:
        return F.lit(0)
    bounds = df.agg(F.percentile_approx(key, shares, 10 * buckets).alias("bounds")).first()["bounds"]
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))), lambda b: b < F.col(key)))


def filtered(docs: DataFrame, least_words: int = 3, text_col: str = "text") -> DataFrame:
    """Texts that aren't null or blank and have enough words; no more of a text is looked at than it takes to tell."""
    return docs.where(has_words(F.col(text_col), max(1, least_words)))


def indexed(docs: DataFrame, key: str, least_words: int = 3, buckets: int | None = None, text_col: str = "text") -> DataFrame:
    """Adds idx, the place among the texts that survive the filter, in the order of `key`; keys name a row.

    Places come from a table of the keys alone, so texts are not sorted.
    """
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = filtered(docs, least_words, text_col)
    keys = staged(kept.select(key))
    return kept.join(ranked(keys, key_bucket(keys, key, buckets), [F.col(key)], "idx"), key)


def index_range(docs: DataFrame, key: str, start: int = 0, end: int | None = None, least_words: int = 3) -> DataFrame:
    """Rows with start <= idx < end. Bad bounds raise ValueError; an empty range gives no rows."""
    if start < 0 or (end is not None and end <= start):
        raise ValueError("need 0 <= start < end")
    out = indexed(docs, key, least_words).where(F.col("idx") >= start)
    return out if end is None else out.where(F.col("idx") < end)


def source_at(docs: DataFrame, key: str, index: int, least_words: int = 3) -> DataFrame:
    """The row with that idx."""
    return index_range(docs, key, index, index + 1, least_words)


def by_prefix(probes: DataFrame, source: DataFrame, count: int = 20, radius: int = 2000) -> DataFrame:
    """For each probe (probe_id, words, hint) the first source row (idx, words) that begins with the probe's first words.

    Up to `count` words, or all of a shorter probe's, must agree, and idx lie from hint - radius to hint + radius. Source
    rows and probes that begin alike are dealt into bands of idx and put in one order there; a probe takes the first
    source row from where its range begins. A range reaches into two bands, so source rows stand in their own band and
    in the one before. Rows are sorted, not paired: an opening that all texts share costs no more than others.
    """
    width = 2 * radius + 1
    first = F.slice("words", 1, count)
    asks = probes.where(F.size("words") > 0).select("probe_id", F.col("hint").cast("long").alias("hint"), F.size(first).alias("size"), F.array_join(first, " ").alias("opening"))
    lengths = asks.select("size").distinct()  # at most `count` rows
    held = source.select(F.col("idx").cast("long").alias("idx"), first.alias("held")).where(F.size("held") > 0)
    cut = held.select("idx", "held", F.explode(F.sequence(F.lit(1), F.size("held"))).alias("size")).join(F.broadcast(lengths), "size")
    band = lambda at: F.floor(at / width).cast("long")
    none = F.lit(None).cast("long")
    start = F.col("hint") - radius
    places = cut.select("size", F.array_join(F.slice("held", F.lit(1), F.col("size")), " ").alias("opening"), F.explode(F.array(band(F.col("idx")) - 1, band(F.col("idx")))).alias("band"), F.col("idx").alias("at"), F.col("idx").alias("row"))
    starts = asks.select("size", "opening", band(start).alias("band"), start.alias("at"), none.alias("row")).distinct()
    following = Window.partitionBy("size", "opening", "band").orderBy("at", F.col("row").asc_nulls_first()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    next_row = starts.unionByName(places).withColumn("idx", F.min("row").over(following)).where(F.col("row").isNull() & (F.col("idx") <= F.col("at") + 2 * radius))
    met = asks.withColumn("at", start).join(next_row.select("size", "opening", "at", "idx"), ["size", "opening", "at"])
    return met.groupBy("probe_id").agg(F.min("idx").alias("idx"))


def resolve(probes: DataFrame, sources: dict[int, DataFrame]) -> DataFrame:
    """probe_id, idx, how, min_words: where each probe (probe_id, words, hint, min_words) comes from.

    `sources` has the corpus (idx, words) under each filter by least words that may have been used. The row at the
    probe's own index and filter is taken if it begins alike; else the filters are gone through in ascending order, and
    the first row nearby that begins alike is taken.
    """
    out = probes.select("probe_id", "words", "hint", "min_words")
    own = None
    for least, source in sources.items():
        part = source.select(F.lit(least).alias("min_words"), F.col("idx").alias("hint"), F.slice("words", 1, 20).alias("there"))
        own = part if own is None else own.unionByName(part)
    direct = out.join(own, ["min_words", "hint"]).where(starts_equal(F.col("there"), F.slice("words", 1, 20))).select("probe_id", F.col("hint").alias("at"))
    near = [by_prefix(probes, sources[n]).withColumn("least", F.lit(n)) for n in sorted(sources)]
    found = reduce(DataFrame.unionByName, near).groupBy("probe_id").agg(F.min(F.struct("least", "idx")).alias("near"))
    out = out.select("probe_id", "min_words").join(direct, "probe_id", "left").join(found, "probe_id", "left")
    how = F.when(F.col("at").isNotNull(), "index").when(F.col("near").isNotNull(), "prefix").otherwise("none")
    least = F.when(F.col("at").isNotNull(), F.col("min_words")).otherwise(F.col("near.least"))
    return out.select("probe_id", F.coalesce("at", "near.idx").alias("idx"), how.alias("how"), least.alias("least_words"))


def source_texts(found: DataFrame, sources: dict[int, DataFrame], docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """What `resolve` has found, with the source row's key and its whole text; probes without a source are left out.

    `sources` has the key and idx of the corpus under each filter, `docs` its texts.
    """
    keys = reduce(DataFrame.unionByName, [s.select(F.lit(n).alias("least_words"), "idx", key) for n, s in sources.items()])
    return found.join(keys, ["least_words", "idx"]).join(docs.select(key, text_col), key)
