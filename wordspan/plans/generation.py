"""Registered queries of generation: requests by mode, segments held against the source, runs, chunks, token rows."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordspan.functions import labels as L
from wordspan.functions.once import once
from wordspan.functions.probability import argmax_of_two, render
from wordspan.functions.rng import draw32
from wordspan.functions.text import chunk_range, join_words, preview, setting, tokens
from wordspan.operators import generate, metrics, modes, score, splits, windows
from wordspan.plans.queries import AI_SEED, SEED, pieces_of, pseudo, sample_texts, samples, table
from wordspan.sources import catalog, chunks, token_rows
from wordspan.sources.staging import new_path, staged

#: Windows that windows_to_target stops at.
TARGET = 1000


def by_mode(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every mode gets the documents of one remainder of the id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return {m: docs.where(F.col("doc_id") % len(modes.MODES) == k) for k, m in enumerate(modes.MODES)}


def generation_requests(spark, sf_dir):
    first, *rest = (modes.requests(docs, m, SEED, "doc_id") for m, docs in by_mode(spark, sf_dir).items())
    for part in rest:
        first = first.unionByName(part)
    return first


def mode_of_id():
    return F.element_at(F.array(*map(F.lit, modes.MODES)), (F.col("doc_id") % len(modes.MODES) + 1).cast("int"))


def source_segments(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", mode_of_id().alias("mode"), (3 + F.col("doc_id") % 5).cast("int").alias("n_start"), (F.col("doc_id") % 7).cast("int").alias("n_end"))
    return modes.source_segments(docs).select("doc_id", "mode", *(join_words(F.col(c)).alias(c) for c in ("source_start", "source_end", "skipped")))


def segment_comparison(spark, sf_dir):
    """Samples that keep both ends of a text, held against it; every sixth against a text in other letters."""
    docs = once(table(spark, sf_dir, "documents").select("doc_id", "text"), w=tokens(F.col("text"))).where(F.size("w") >= 15)
    head, tail = (3 + F.col("doc_id") % 5).cast("int"), (F.col("doc_id") % 4).cast("int")
    new = F.array(*[F.lit("new")] * 4)
    made = docs.select("doc_id", "text", F.concat(F.slice("w", F.lit(1), head), new, F.when(tail > 0, F.slice("w", -tail, tail)).otherwise(F.array().cast("array<string>"))).alias("words"), L.build((0, head), (1, F.lit(4)), (0, tail)).alias("labels"))
    parted = once(made, detected=L.mode(F.col("labels")), s=L.segments(F.col("words"), F.col("labels")))
    stated = F.when(F.col("doc_id") % 5 != 0, mode_of_id()).otherwise("none")
    found = parted.select("doc_id", F.when(F.col("doc_id") % 6 == 0, F.upper("text")).otherwise(F.col("text")).alias("text"), "detected", modes.split_mode(F.col("detected"), stated).alias("mode"), F.col("s.human_start").alias("human_start"), F.col("s.human_end").alias("human_end"), F.size("s.human_start").alias("n_start"), F.size("s.human_end").alias("n_end"))
    out = modes.compared(modes.source_segments(found))
    return out.select("doc_id", "detected", "mode", "n_start", "n_end", "start_match", "end_match", F.coalesce(F.size("skipped"), F.lit(-1)).alias("n_skipped"))


def fake_generator():
    """Stands for a generator: by the prompt's hash it refuses for good, says nothing, or answers."""

    def answer(prompt: str, budget: int, model: str) -> str:
        fate = int(hashlib.md5(prompt.encode()).hexdigest()[:8], 16) % 10
        if fate == 0:
            raise generate.Permanent("never")
        return "" if fate == 1 else f"{model} answers"

    return answer


def run_counters(spark, sf_dir):
    done = generate.generated(generation_requests(spark, sf_dir), fake_generator, ["a", "b", "c"])
    return metrics.run_counters(done, "mode").join(done.groupBy("mode").agg(F.sum("attempts").alias("attempts")), "mode")


def ready_chunks(spark, sf_dir):
    """Order lines stand for result slots, of which some are skipped, failed or not yet there."""
    fate = F.col("l_partkey") % 300
    status = F.when(fate == 0, None).when(fate < 20, "skipped").when(fate < 30, "failed").otherwise("generated")
    slots = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("split"), F.col("l_orderkey").alias("idx"), status.alias("status"))
    return chunks.ready(slots, 100)


def stored(spark: SparkSession, sf_dir: str) -> str:
    """Conversations as stored samples, some with faults; returns the folder."""
    rows = samples(spark, sf_dir)
    fault = F.col("conv_id") % 10
    marks = F.when(fault == 0, F.slice("label", 2, F.size("label"))).when(fault == 1, F.transform("label", lambda x: x * 2)).otherwise(F.col("label"))
    made = rows.select(join_words(F.col("words")).alias("text"), marks.alias("labels"), F.concat(F.lit("m"), (F.col("conv_id") % 9).cast("string")).alias("model"), F.col("conv_id").alias("idx"), F.lit(None).cast("int").alias("min_words_filter"), F.when(F.col("conv_id") % 4 == 0, "append").alias("generation_mode"), F.when(F.col("conv_id") % 3 == 0, "test").otherwise("train").alias("split"))
    path = new_path(spark, "chunks")
    chunks.write(made, path, 20)
    return path


def chunk_listing(spark, sf_dir):
    path = stored(spark, sf_dir)
    models = chunks.read(spark, path).groupBy("split", "chunk_id").agg(F.sort_array(F.collect_set("model")).alias("models"))
    return chunks.listed(spark, path).join(models, ["split", "chunk_id"]).withColumn("models", chunks.models_preview(F.col("models")))


def chunk_samples(spark, sf_dir):
    """A range of a split, read from its chunks alone and validated."""
    part = chunks.read_range(spark, stored(spark, sf_dir), "train", 7, 75)
    return chunks.validated(part, "sandwich").select("idx", "model", "source_mode", F.size("label").alias("n"), "text")


def chunk_faults(spark, sf_dir):
    return chunks.faults(chunks.read(spark, stored(spark, sf_dir)))


def token_metrics(spark, sf_dir):
    ids = once(samples(spark, sf_dir), word_ids=pieces_of(F.col("words")))
    rows = ids.select("conv_id", F.posexplode(L.align(F.col("label"), F.col("word_ids"))).alias("tok", "label"))
    p = pseudo(F.col("conv_id"), F.col("tok"), "m")
    return metrics.token_metrics(rows.select((F.col("conv_id") % 5).alias("part"), "label", argmax_of_two(1 - p, p).alias("prediction")), "part")


def four_characters(words: list[str]) -> tuple[list[int], list[int | None]]:
    own = [k for k, w in enumerate(words) for _ in range(-(-len(w) // 4))]
    return [0, *(k + 1 for k in own), 0], [None, *own, None]


def token_row_cache(spark, sf_dir):
    """Token rows, made by the first call and read by the second."""
    given = staged(samples(spark, sf_dir).select("conv_id", "words", F.col("label").alias("labels")))
    folder = new_path(spark, "cache")
    token_rows.cached(given, four_characters, "four", 64, folder, "conv_id")
    rows = token_rows.cached(given, four_characters, "four", 64, folder, "conv_id")
    return rows.select("conv_id", "input_ids", "labels")


def windows_to_target(spark, sf_dir):
    return windows.to_target(table(spark, sf_dir, "documents").select("doc_id", "text"), AI_SEED, "doc_id", 1, TARGET)


def augment_yield(spark, sf_dir):
    given = sample_texts(spark, sf_dir)
    return windows.yields(given, windows.boundary_windows(given, SEED, "conv_id"), "conv_id", 10)


def hashed_scorer():
    return lambda texts: [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 21 / 20 for t in texts]


def document_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score.scored_documents(docs, hashed_scorer, "doc_id")


def text_helpers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    lo = F.col("doc_id") * 10
    name = F.when(F.col("doc_id") % 7 == 0, "notes.pt").otherwise(F.concat_ws("_", "source", lo.cast("string"), F.concat((lo + 9).cast("string"), F.lit(".pt"))))
    return docs.select("doc_id", preview(F.col("text"), 60).alias("preview"), setting(F.concat(F.lit("  "), F.left("text", F.lit(12)), F.lit(" # "), F.col("source"))).alias("setting"), chunk_range(name)["lo"].alias("lo"), chunk_range(name)["hi"].alias("hi"))


def score_report(spark, sf_dir):
    """The first words with their marks, the likelier class, and what a request would cost."""
    p = lambda x, i: F.when(i % 11 == 3, None).otherwise(pseudo(F.col("conv_id"), i, "r"))
    marked = once(samples(spark, sf_dir).select("conv_id", "words"), p=F.transform(F.slice("words", 1, 60), lambda x, i: p(x, i)))
    a, b = (draw32(7, F.col("conv_id"), k) % 9 for k in ("a", "b"))
    n = F.size("words")
    return marked.select("conv_id", render(F.col("words"), F.col("p")).alias("line"), argmax_of_two(a, b).alias("likelier"), F.round(catalog.cost(n, F.lit(50), F.lit(0.0015), F.lit(0.002)), 6).alias("cost"))


def whole_prompts(spark, sf_dir):
    """Prompts that ask for a text again from its ends and a summary, for which the opening of the middle stands."""
    cut = splits.three_parts(table(spark, sf_dir, "documents").select("doc_id", "text")).where("how is not null")
    prompt = modes.whole_prompt(join_words(F.slice("middle", 1, 12)), join_words(F.col("begin")), join_words(F.col("end")), F.size("middle"))
    return cut.select("doc_id", prompt.alias("prompt"))


def hashed_words():
    """Stands for a word scorer: the word's hash in steps of a twentieth; what comes after 40 words is cut off."""
    p = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 21 / 20
    return lambda lists: [[p(w) if k < 40 else None for k, w in enumerate(words)] for words in lists]


def word_predictions(spark, sf_dir):
    """Every word with its score and name, and what that makes of its text."""
    given = samples(spark, sf_dir).select("conv_id", "words", F.col("label").alias("labels"))
    out = score.predictions(score.scored_words(given, hashed_words, "conv_id").drop("y"), "conv_id")
    return out.withColumn("doc_p", F.round("doc_p", 9))


def evaluated_scorer(spark, sf_dir):
    """Metrics of a scorer by group of conversations."""
    given = samples(spark, sf_dir).select("conv_id", "words", F.col("label").alias("labels"), (F.col("conv_id") % 4).alias("part"))
    return score.evaluated(given, hashed_words, "conv_id", "part").withColumns({c: F.round(c, 6) for c in ("ap", "reward", "label_rate", "predicted_rate", "accuracy")})


def normalised_labels(spark, sf_dir):
    """Labels that come as JSON text, as doubles and as longs, as ints."""
    rows = samples(spark, sf_dir)
    return rows.select("conv_id", L.parsed_ints(F.concat(F.lit("["), F.array_join(F.transform("label", lambda x: x.cast("string")), ", "), F.lit("]"))).alias("from_text"), L.as_ints(F.transform("label", lambda x, k: x.cast("double") + F.when(k % 5 == 4, 0.5).otherwise(0.0))).alias("from_doubles"), L.as_ints(F.col("label").cast("array<long>")).alias("from_longs"))


ALL = [whole_prompts, word_predictions, evaluated_scorer, normalised_labels, generation_requests, source_segments, segment_comparison, run_counters, ready_chunks, chunk_listing, chunk_samples, chunk_faults, token_metrics, token_row_cache, windows_to_target, augment_yield, document_scores, text_helpers, score_report]
