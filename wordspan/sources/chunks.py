"""Chunked storage of generated samples: partitioned Parquet, a manifest of index ranges, and pruning by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordspan.functions.labels import is_valid
from wordspan.functions.text import tokens, word_count

SCHEMA = "text string, labels array<int>, model string, idx long, min_words_filter int, generation_mode string"
NEEDED = ("text", "labels", "model", "idx")


def chunk_of(idx: Column, chunk_size: int, first: int = 0) -> Column:
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    return F.floor((idx - first) / chunk_size).cast("long")


def write(samples: DataFrame, path: str, chunk_size: int = 1000, first: int = 0) -> None:
    """Writes samples (split and the columns of SCHEMA), a folder for each split and chunk; chunks without rows have none.

    The manifest of what is written goes to _manifest. Without samples ValueError is raised.
    """
    placed = samples.withColumn("chunk_id", chunk_of(F.col("idx"), chunk_size, first))
    if samples.isEmpty():
        raise ValueError("cannot write chunks without samples")
    placed.repartition("split", "chunk_id").write.mode("append").partitionBy("split", "chunk_id").parquet(path)
    folder = F.concat(F.lit("split="), F.col("split"), F.lit("/chunk_id="), F.col("chunk_id").cast("string"))
    manifest(placed, "split", "chunk_id").withColumn("folder", folder).write.mode("append").parquet(f"{path}/_manifest")


def read(spark: SparkSession, path: str, splits: list[str] | None = None) -> DataFrame:
    """Reads chunks; missing columns raise ValueError. Splits prune folders."""
    found = spark.read.parquet(path)
    if missing := [c for c in NEEDED if c not in found.columns]:
        raise ValueError(f"chunks lack {missing}")
    return found.where(F.col("split").isin(splits)) if splits else found


def splits_of(samples: DataFrame) -> DataFrame:
    return samples.select("split").distinct().orderBy("split")


def validated(samples: DataFrame, source_mode: str) -> DataFrame:
    """Samples whose words and labels agree, as (text, label, source_mode, idx, model, chunk)."""
    good = samples.where(is_valid(tokens(F.col("text")), F.col("labels")))
    return good.select("text", F.col("labels").alias("label"), F.coalesce("generation_mode", F.lit(source_mode)).alias("source_mode"), "idx", "model", F.col("chunk_id").alias("chunk"))


def manifest(samples: DataFrame, *by: str) -> DataFrame:
    """lo, hi and n for each chunk; lo and hi span the indices that are there."""
    return samples.groupBy(*by).agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.count("*").alias("n"))


def overlapping(manifest: DataFrame, start: int, end: int) -> DataFrame:
    """Chunks that may hold an index from start to before end; those with unknown range stay."""
    return manifest.where(F.col("lo").isNull() | ((F.col("hi") + 1 > start) & (F.col("lo") < end)))


def summary(samples: DataFrame, *by: str) -> DataFrame:
    """n, first and last index in stored order (column pos), average words and labels, and the models, sorted."""
    ends = [f(F.struct("pos", "idx"))["idx"].alias(n) for f, n in ((F.min, "first_idx"), (F.max, "last_idx"))]
    return samples.groupBy(*by).agg(F.count("*").alias("n"), *ends, F.avg(word_count(F.col("text"))).alias("avg_words"), F.avg(F.size("labels")).alias("avg_labels"), F.sort_array(F.collect_set("model")).alias("models"))


def listed(spark: SparkSession, path: str) -> DataFrame:
    """name (split_lo_hi), split, chunk_id, lo, hi and n of every stored chunk; `place` is the order of the names."""
    found = manifest(read(spark, path), "split", "chunk_id")
    named = found.withColumn("name", F.concat_ws("_", "split", F.col("lo").cast("string"), F.col("hi").cast("string")))
    return named.withColumn("place", F.row_number().over(Window.partitionBy("split").orderBy("name")))


def read_range(spark: SparkSession, path: str, split: str, start: int, end: int) -> DataFrame:
    """A split's samples with start <= idx < end; the manifest says which chunks are opened."""
    from wordspan.sources import planned

    return planned.read_range(spark, path, split, start, end)


def faults(samples: DataFrame) -> DataFrame:
    """n, valid, and samples dropped because their labels don't fit their words or aren't 0 and 1, by split."""
    words = F.size(tokens(F.col("text")))
    fits, binary = words == F.size("labels"), F.forall("labels", lambda x: x.isin(0, 1))
    return samples.groupBy("split").agg(F.count("*").alias("n"), F.count_if(fits & binary).alias("valid"), F.count_if(~fits).alias("misaligned"), F.count_if(fits & ~binary).alias("bad_labels"))


#: Models named in a preview.
SHOWN = 5


def models_preview(models: Column) -> Column:
    """The first few of sorted models, and how many more there are."""
    more = F.size(models) - SHOWN
    return F.concat(F.array_join(F.slice(models, 1, SHOWN), ", "), F.when(more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(" more)"))).otherwise(""))


def ready(slots: DataFrame, chunk_size: int, first: int = 0) -> DataFrame:
    """Chunks of result slots (split, idx, status) that can be written: every slot is resolved, and not all are skipped.

    split, chunk_id, n (samples to write) and dropped (slots without a sample).
    """
    chunk = chunk_of(F.col("idx"), chunk_size, first)
    done = F.col("status").isin("generated", "skipped", "failed")
    out = slots.groupBy("split", chunk.alias("chunk_id")).agg(F.bool_and(F.coalesce(done, F.lit(False))).alias("whole"), F.count_if(F.col("status") == "generated").alias("n"), F.count("*").alias("slots"))
    return out.where("whole AND n > 0").select("split", "chunk_id", "n", (F.col("slots") - F.col("n")).alias("dropped"))
