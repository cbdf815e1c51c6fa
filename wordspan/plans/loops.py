"""Registered queries of runs that go on: generation under cooldowns, chunks committed as they fill, planned reads."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import functions as F

from wordspan.functions.failures import Failed
from wordspan.functions.once import once
from wordspan.functions.rng import draw
from wordspan.functions.text import first_words, join_words
from wordspan.operators import dataset, generate, observed, windows
from wordspan.operators.entries import Entry
from wordspan.plans.generation import fake_generator, generation_requests
from wordspan.plans.queries import AI_SEED, SPLIT_SEED, boundary_windows, merged, samples, table
from wordspan.sources import commits, planned
from wordspan.sources import rejects as rejected
from wordspan.sources.staging import new_path, staged
from wordspan.streaming import generation

#: Lanes of a run and the models of each.
LANES, MODELS = 32, ["red", "blue", "green", "grey"]
NO_CHOICE = object()
#: What a stand-in for a generator does: below which roll of 200, and what it raises; None: it answers, '': blank.
ROLLS = [
    (110, None),
    (135, Failed("rate", 429, '{"error": {"message": "", "metadata": {"retry_after_seconds": 7}}}', "too many requests")),
    (145, Failed("rate", 429, None, "too many requests")),
    (160, Failed("timeout", None, None, "timed out")),
    (166, ""),
    (170, NO_CHOICE),
    (172, Failed("status", 503, None, "overloaded")),
    (173, Failed("rate", 429, '{"error": {"message": "Daily limit reached"}}', "no more today")),
    (185, Failed("status", 400, None, "maximum context is 4096 tokens")),
    (200, Failed("status", 418, None, "teapot")),
]


def rolling():
    def ask(entry: Entry, model: str) -> str:
        roll = int(md5(f"9|{entry.id}|{entry.asked}|{model}".encode()).hexdigest()[:8], 16) % 200
        what = next(w for most, w in ROLLS if roll < most)
        if isinstance(what, Failed):
            raise what
        return None if what is NO_CHOICE else f"{model} continues {entry.prompt}" if what is None else what

    return ask


def generation_with_cooldowns(spark, sf_dir):
    """Every document is a request of a stream; what came of it, after how many attempts, and how long it waited."""
    docs = table(spark, sf_dir, "documents")
    asked = docs.select(F.col("doc_id").alias("id"), join_words(first_words(F.col("text"), 4)).alias("prompt"), F.lit(64).alias("max_tokens"), (F.col("doc_id") / 4 + 1).alias("at"))
    base = new_path(spark, "generation")
    asked.write.parquet(f"{base}/in")
    generation.closing(spark.read.schema(asked.schema).parquet(f"{base}/in")).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(asked.schema).parquet(f"{base}/in")
    done = generation.outcomes(stream, rolling, MODELS, lane=F.col("id") % LANES)
    writer = done.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    generation.started(writer, spark).awaitTermination()
    return spark.read.schema(done.schema).parquet(f"{base}/out").withColumn("waited", F.round("waited", 6))


#: Slots of a chunk.
CHUNK = 20


def places(spark, sf_dir):
    """Documents as places in two splits; some are skipped or failed, a few are never resolved, one chunk in seven is all skipped."""
    test = F.col("doc_id") % 3 == 0
    idx = F.when(test, F.floor(F.col("doc_id") / 3)).otherwise(F.col("doc_id") - F.floor(F.col("doc_id") / 3) - 1)
    fate = draw(13, F.col("doc_id"), "slot", below=F.lit(150))
    status = F.when(F.floor(F.col("idx") / CHUNK) % 7 == 3, "skipped").when(fate == 0, None).when(fate < 10, "skipped").when(fate < 15, "failed").otherwise("generated")
    return table(spark, sf_dir, "documents").withColumns({"split": F.when(test, "test").otherwise("train"), "idx": idx}).withColumn("status", status)


def slots(spark, sf_dir):
    """The resolved places and their samples, of the first words of each text."""
    words = once(places(spark, sf_dir).where("status IS NOT NULL"), w=first_words(F.coalesce(F.col("text"), F.lit("")), 40))
    return words.select("split", "idx", "status", join_words(F.col("w")).alias("text"), F.transform("w", lambda _, k: (k % 2).cast("int")).alias("labels"), F.concat(F.lit("m"), (F.col("doc_id") % 5).cast("string")).alias("model"), F.lit(3).alias("min_words_filter"), F.lit("append").alias("generation_mode"))


def committed(spark, sf_dir):
    """A run whose slots come as a stream of files; the folder of its chunks, and the run's slots by split."""
    base = new_path(spark, "run")
    given = slots(spark, sf_dir)
    totals = {r["split"]: r["n"] for r in places(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n")).collect()}
    given.repartition(6).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
    stream.writeStream.foreachBatch(commits.sink(f"{base}/store", CHUNK, totals)).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return f"{base}/store", totals, given.schema


def committed_chunks(spark, sf_dir):
    """What is committed when the stream has come to its end, and then what the end of the run commits."""
    path, totals, schema = committed(spark, sf_dir)
    commits.finish(spark, path, CHUNK, totals, schema)
    return commits.manifest(spark, path).drop("folder")


def committed_range(spark, sf_dir):
    """A range of a split of a run that has not ended, read from the chunks that may hold it."""
    path, _, _ = committed(spark, sf_dir)
    return planned.read_range(spark, path, "train", 50, 290).select("chunk_id", "idx", "text", F.size("labels").alias("n"), "model")


def leak_free_split(spark, sf_dir):
    """Windows split so that no conversation or document is in two splits."""
    placed = dataset.split_groups(staged(merged(spark, sf_dir)), SPLIT_SEED, ["kind", "id"])
    return placed.groupBy("split", "kind", "id").agg(F.count("*").alias("n"))


def faulty(spark, sf_dir):
    """Conversations as samples, some with faults."""
    rows, fault = samples(spark, sf_dir), F.col("conv_id") % 12
    text, model = join_words(F.col("words")), F.concat(F.lit("m"), (F.col("conv_id") % 9).cast("string"))
    marks = F.when(fault == 0, F.slice("label", 2, F.size("label"))).when(fault == 1, F.transform("label", lambda x: x * 2)).when(fault == 2, None).when(fault == 3, F.transform("label", lambda x, k: F.when(k > 0, x))).otherwise(F.col("label"))
    return rows.select("conv_id", F.when(fault == 4, None).when(fault == 5, F.lit(" \n")).otherwise(text).alias("text"), marks.alias("labels"), F.when(fault == 6, None).otherwise(model).alias("model"), F.when(fault == 7, None).otherwise(F.col("conv_id")).alias("idx"))


def sample_rejects(spark, sf_dir):
    """Every sample, valid or with its reason, from the folders that one pass has written."""
    valid, rejects = rejected.parted(faulty(spark, sf_dir), new_path(spark, "parted"))
    kept = valid.select("conv_id", F.lit(rejected.VALID).alias("reason"), F.lit("").alias("message"))
    return kept.unionByName(rejects.select("conv_id", "reason", "message"))


def observed_windows(spark, sf_dir):
    """Counters of label-boundary windows, gathered while they are written."""
    seen = observed.written(boundary_windows(spark, sf_dir), new_path(spark, "windows"), observed.window_counts())
    return spark.createDataFrame([seen], "windows long, words long, ones long, least long, most long")


def observed_run(spark, sf_dir):
    """Counters of a run, gathered while its results are written."""
    done = generate.generated(generation_requests(spark, sf_dir), fake_generator, ["a", "b", "c"])
    seen = observed.written(done, new_path(spark, "results"), observed.run_counts(), "mode")
    return spark.createDataFrame([seen], "generated long, skipped long, failed long, total long")


#: Windows that streamed_to_target stops at, and folders that its texts are in.
TARGET, FOLDERS = 700, 16


def streamed_to_target(spark, sf_dir):
    """Windows of as many folders of texts as it takes, in the order of a seed."""
    base = new_path(spark, "target")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % FOLDERS).alias("part"))
    texts.repartition("part").write.partitionBy("part").parquet(f"{base}/texts")
    return windows.stream_to_target(spark, f"{base}/texts", f"{base}/run", AI_SEED, "doc_id", 1, TARGET, "doc_id long, text string")


ALL = [generation_with_cooldowns, committed_chunks, committed_range, leak_free_split, sample_rejects, observed_windows, observed_run, streamed_to_target]
