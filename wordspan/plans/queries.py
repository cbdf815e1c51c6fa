"""The registered queries. Each takes a session and a folder of tables and returns its whole result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordspan.functions import errors
from wordspan.functions import labels as L
from wordspan.functions.once import once
from wordspan.functions.probability import hard_label, named_label
from wordspan.functions.rng import draw, draw32
from wordspan.functions.text import block_starts, first_words, join_words, sentences, sum_before, tokens, word_count
from wordspan.operators import align, dataset, metrics, profile, splits, windows
from wordspan.sources import catalog, chunks, corpus
from wordspan.sources.staging import new_path, staged
from wordspan.streaming import cooldown

SEED, AI_SEED, SPLIT_SEED = 42, 44, 42
#: Opening instructions of prompts, to choose from.
OPENINGS = ("Summarise the text in a few sentences.", "Give a short overview of the text.", "State the main points of the text.", "Write a synopsis of the text.")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", word_count(F.col("text")).alias("wc"))


def word_profile_by_lang(spark, sf_dir):
    return profile.stats(counted(spark, sf_dir), "lang")


def word_profile_by_source_file(spark, sf_dir):
    rows = counted(spark, sf_dir)
    both = rows.groupingSets([["source", "lang"], ["source"]], "source", "lang")
    return both.agg(F.count("*").alias("n"), F.min("wc").alias("least"), F.max("wc").alias("most"), F.countDistinct("lang").alias("langs"))


def shortest_longest_per_group(spark, sf_dir):
    return profile.extremes(counted(spark, sf_dir), "lang", ["source", "doc_id"])


def upper_median_lengths(spark, sf_dir):
    return profile.spread(counted(spark, sf_dir), "lang")


def filtered_index_range(spark, sf_dir):
    return corpus.index_range(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 100, 700, 30).select("doc_id", "idx", word_count(F.col("text")).alias("wc"))


def source_point_lookup(spark, sf_dir):
    return corpus.source_at(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 123).select("doc_id", "idx", "text")


#: Filters under which a sample's index may have been taken.
FILTERS = (3, 15, 30)


def prefix_probes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[int, DataFrame]]:
    """Each text's opening, sought at an index near its own, which every third one counts under a stricter filter; the corpus by filter."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    sources = {n: staged(corpus.indexed(texts, "doc_id", n).select("doc_id", "idx", first_words(F.col("text"), 25).alias("words"))) for n in FILTERS}
    opening = sources[3].select(F.col("doc_id").alias("probe_id"), "words", "idx", F.lit(3).alias("min_words"))
    strict = sources[30].select(F.col("doc_id").alias("probe_id"), F.col("idx").alias("strict_idx"))
    hint = F.when(F.col("probe_id") % 3 == 0, F.coalesce("strict_idx", "idx")).otherwise(F.col("idx")) + F.col("probe_id") % 5 - 2
    return opening.join(strict, "probe_id", "left").select("probe_id", "words", hint.alias("hint"), "min_words"), sources


def prefix_source_match(spark, sf_dir):
    probes, sources = prefix_probes(spark, sf_dir)
    return corpus.resolve(probes, {n: s.select("idx", "words") for n, s in sources.items()})


def prefix_source_texts(spark, sf_dir):
    """The source row of every opening, with its whole text."""
    probes, sources = prefix_probes(spark, sf_dir)
    found = corpus.resolve(probes, {n: s.select("idx", "words") for n, s in sources.items()})
    return corpus.source_texts(found, sources, table(spark, sf_dir, "documents"), "doc_id").select("probe_id", "doc_id", "idx", "how", "text")


def sentence_segments(spark, sf_dir):
    docs = once(table(spark, sf_dir, "documents").select("doc_id", "text"), parts=sentences(F.col("text"))).select("doc_id", "parts")
    sums = once(once(docs, lengths=F.transform("parts", F.length)), starts=block_starts(F.col("lengths")))
    lengths, starts = F.col("lengths"), F.col("starts")
    rows = F.transform("parts", lambda part, k: F.struct(k.alias("pos"), part.alias("sentence"), sum_before(lengths, starts, k).alias("begin")))
    return once(sums, rows=rows).select("doc_id", F.inline("rows"))


def prefix_suffix_split(spark, sf_dir):
    cut = splits.prefix_suffix(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "how", "reason", join_words(F.col("prefix")).alias("prefix"), join_words(F.col("suffix")).alias("suffix"))


def three_part_split(spark, sf_dir):
    cut = splits.three_parts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "how", "reason", *(join_words(F.col(c)).alias(f"{c}_text") for c in ("begin", "middle", "end")))


def append_plan(spark, sf_dir):
    plan = splits.append_plan(table(spark, sf_dir, "documents").select("doc_id", "text"), SEED, "doc_id")
    return plan.select("doc_id", "cut", "need", "total", "kept", splits.token_budget(F.col("need")).alias("budget"))


def sandwich_plan(spark, sf_dir):
    plan = splits.sandwich_plan(table(spark, sf_dir, "documents").select("doc_id", "text"), SEED, "doc_id")
    return plan.select("doc_id", "start", "tail", "need", "head_text", "tail_text", splits.token_budget(F.col("need")).alias("budget"))


def prompt_plan(spark, sf_dir):
    cut = splits.three_parts(table(spark, sf_dir, "documents").select("doc_id", "text")).where("how is not null")
    n = F.size("middle")
    which = draw(SEED, F.col("doc_id"), "opening", below=F.lit(len(OPENINGS))).cast("int")
    opening = F.element_at(F.array(*map(F.lit, OPENINGS)), which + 1)
    prompt = F.concat(opening, F.lit("\n\nText:\n"), join_words(F.col("middle")))
    return cut.select("doc_id", n.alias("words"), splits.summary_words(n).alias("summary_words"), splits.token_budget(n).alias("budget"), prompt.alias("prompt"))


def mixed_labels(spark, sf_dir):
    """The middle words in reverse stand for generated text."""
    cut = splits.three_parts(table(spark, sf_dir, "documents").select("doc_id", "text")).where("how is not null")
    made = cut.select("doc_id", splits.mixed(F.col("begin"), F.reverse("middle"), F.col("end")).alias("m"))
    return made.select("doc_id", "m.full_text", "m.labels")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, words, label: a conversation's words in order of turns, the assistant's labelled 1."""
    said = table(spark, sf_dir, "conversations").withColumns({"w": tokens(F.coalesce("text", F.lit(""))), "l": (F.col("role") == "assistant").cast("int")})
    turns = said.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "l", "w"))).alias("turns"))
    words = F.flatten(F.transform("turns", lambda t: t["w"]))
    marks = F.flatten(F.transform("turns", lambda t: F.array_repeat(t["l"], F.size(t["w"]))))
    return once(turns, words=words, label=marks).drop("turns")


def conversation_word_labels(spark, sf_dir):
    return samples(spark, sf_dir).select("conv_id", join_words(F.col("words")).alias("text"), "label")


def label_boundaries(spark, sf_dir):
    b = L.boundaries(F.col("label"))
    return samples(spark, sf_dir).select("conv_id", F.size("label").alias("n"), b.alias("boundaries"), F.size(b).alias("n_boundaries"), L.is_valid(F.col("words"), F.col("label")).alias("valid"))


def detect_mode_distribution(spark, sf_dir):
    from pyspark.sql import Window

    modes = samples(spark, sf_dir).select(F.floor(F.col("conv_id") / 20).cast("long").alias("chunk"), L.mode(F.col("label")).alias("mode")).groupBy("chunk", "mode").agg(F.count("*").alias("n"))
    return modes.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("chunk")))


def label_segments(spark, sf_dir):
    parts = samples(spark, sf_dir).where(L.is_valid(F.col("words"), F.col("label"))).select("conv_id", L.segments(F.col("words"), F.col("label")).alias("s"))
    return parts.select("conv_id", *(join_words(F.slice(f"s.{c}", 1, 15)).alias(c) for c in ("human_start", "generated", "human_end")), *(F.size(f"s.{c}").alias(f"n_{c}") for c in ("human_start", "generated", "human_end")))


def label_segments_whole(spark, sf_dir):
    parts = samples(spark, sf_dir).where(L.is_valid(F.col("words"), F.col("label"))).select("conv_id", L.segments(F.col("words"), F.col("label")).alias("s"))
    return parts.select("conv_id", *(join_words(F.col(f"s.{c}")).alias(c) for c in ("human_start", "generated", "human_end")))


def one_class_windows(spark, sf_dir):
    return windows.one_class_windows(table(spark, sf_dir, "documents").select("doc_id", "text"), SEED, "doc_id", 0)


def labelled_one_class_windows(spark, sf_dir):
    marked = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").where("text <> ''").join(marked, "doc_id", "left_semi")
    return windows.one_class_windows(docs, AI_SEED, "doc_id", 1, copies=16)


def sample_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).select("conv_id", join_words(F.col("words")).alias("text"), "label")


def boundary_windows(spark, sf_dir):
    return windows.boundary_windows(sample_texts(spark, sf_dir), SEED, "conv_id")


def window_audit(spark, sf_dir):
    mixed = boundary_windows(spark, sf_dir).select(F.lit("mixed").alias("kind"), "text", "label")
    human = one_class_windows(spark, sf_dir).select(F.lit("human").alias("kind"), "text", "label")
    return dataset.merge(dataset.audit(mixed, "kind"), dataset.audit(human, "kind", expected=0))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = boundary_windows(spark, sf_dir).select(F.lit("mixed").alias("kind"), F.col("conv_id").alias("id"), "copy", "s", "e")
    human = one_class_windows(spark, sf_dir).select(F.lit("human").alias("kind"), F.col("doc_id").alias("id"), "copy", "s", "e")
    return dataset.merge(mixed, human)


def merged_split_counts(spark, sf_dir):
    placed = dataset.split(dataset.shuffled(staged(merged(spark, sf_dir)), SPLIT_SEED, ["kind", "id", "copy"]))
    return placed.groupBy("split", "kind").agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.sum(F.col("e") - F.col("s")).alias("words"))


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("idx"), F.col("l_linenumber").alias("pos"), F.col("l_linestatus").alias("split"), F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("text"), F.array(F.lit(0), F.lit(1)).alias("labels"), F.col("l_returnflag").alias("model"))
    return lines.withColumn("chunk_id", chunks.chunk_of(F.col("idx"), 500))


def chunk_manifest(spark, sf_dir):
    stored = chunked(spark, sf_dir).withColumn("pos", F.col("idx") * 10 + F.col("pos"))
    return chunks.manifest(stored, "split", "chunk_id").join(chunks.summary(stored, "split", "chunk_id").drop("n"), ["split", "chunk_id"])


def chunk_range_prune(spark, sf_dir):
    return chunks.overlapping(chunks.manifest(chunked(spark, sf_dir), "split", "chunk_id"), 1200, 4300)


def pieces_of(words: Column) -> Column:
    """A toy tokenizer: pieces of four characters; a special token (null word) at both ends."""
    own = F.flatten(F.transform(words, lambda w, i: F.array_repeat(i, F.ceil(F.length(w) / 4).cast("int"))))
    none = F.array(F.lit(None).cast("int"))
    return F.concat(none, own, none)


def subword_label_alignment(spark, sf_dir):
    ids = once(samples(spark, sf_dir), word_ids=pieces_of(F.col("words")))
    return ids.select("conv_id", F.size("word_ids").alias("n_pieces"), F.slice(L.align(F.col("label"), F.col("word_ids")), 1, 256).alias("labels"))


def subword_label_alignment_whole(spark, sf_dir):
    ids = once(samples(spark, sf_dir), word_ids=pieces_of(F.col("words")))
    return ids.select("conv_id", L.align(F.col("label"), F.col("word_ids")).alias("labels"))


def padded_label_batches(spark, sf_dir):
    ids = once(samples(spark, sf_dir), word_ids=pieces_of(F.col("words")))
    rows = ids.select("conv_id", F.floor(F.col("conv_id") / 4).cast("long").alias("batch"), F.transform("word_ids", lambda w: F.coalesce(w + 1, F.lit(0))).alias("input_ids"), F.transform("word_ids", lambda _: F.lit(1)).alias("attention_mask"), L.align(F.col("label"), F.col("word_ids")).alias("labels"))
    return align.padded(rows, "batch")


def pseudo(*keys: Column | str) -> Column:
    """A probability in steps of a twentieth, so that ties and halves come up."""
    return (draw32(7, *keys) % 21).cast("double") / 20


def subwords(spark: SparkSession, sf_dir: str, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Pieces with probabilities, of the first `most` of each conversation if it is given, and the labels of words."""
    own = pieces_of(F.col("words"))
    ids = once(samples(spark, sf_dir), word_ids=own if most is None else F.slice(own, 1, most))
    pieces = ids.select("conv_id", F.posexplode("word_ids").alias("tok", "word_id")).withColumn("p", pseudo(F.col("conv_id"), F.col("tok"), "t"))
    return pieces, ids.select("conv_id", F.col("label").alias("labels"))


def first_subword_probs(spark, sf_dir):
    return align.word_probabilities(*subwords(spark, sf_dir), "conv_id")


def truncation_fallback(spark, sf_dir):
    """What becomes of words beyond a cut of 256 pieces."""
    words = align.word_probabilities(*subwords(spark, sf_dir, 256), "conv_id")
    out = metrics.rates(words, "conv_id").select("conv_id", "scored", "skipped", "skipped_pct", "accuracy")
    filled = words.groupBy("conv_id").agg(*(F.avg(F.coalesce("p", F.lit(v))).alias(f"mean_{k}") for k, v in align.FALLBACK.items()))
    return out.join(filled, "conv_id")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = samples(spark, sf_dir).select("conv_id", F.posexplode("label").alias("word_pos", "y"))
    return words.withColumn("p", pseudo(F.col("conv_id"), F.col("word_pos"), "w"))


def confusion_f1(spark, sf_dir):
    return metrics.confusion(scored(spark, sf_dir).withColumn("part", F.col("conv_id") % 5), "part")


def average_precision(spark, sf_dir):
    return metrics.average_precision(scored(spark, sf_dir).withColumn("part", F.col("conv_id") % 5), "part").withColumn("ap", F.round("ap", 10))


def reward(spark, sf_dir):
    return metrics.reward(scored(spark, sf_dir)).withColumns({"ap": F.round("ap", 10), "reward": F.round("reward", 10)})


def model_comparison(spark, sf_dir):
    models = scored(spark, sf_dir).withColumn("model_id", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))))
    own = models.withColumn("p", pseudo(F.col("conv_id"), F.col("word_pos"), F.col("model_id")))
    return metrics.reward(own, "model_id").withColumns({"ap": F.round("ap", 10), "reward": F.round("reward", 10)})


def document_prob_broadcast(spark, sf_dir):
    """Each document's probability from two logits that a hash gives, repeated for its words."""
    from wordspan.functions.probability import softmax_of_two

    logit = lambda k: (draw32(7, F.col("conv_id"), k) % 9).cast("double") / 2 - 2
    docs = samples(spark, sf_dir).withColumn("doc_p", F.round(softmax_of_two(logit("0"), logit("1")), 10))
    out = docs.select("conv_id", "doc_p", F.array_repeat("doc_p", F.size("words")).alias("p"))
    return out.join(align.document_probability(scored(spark, sf_dir), "conv_id").select("conv_id", F.round("doc_p", 10).alias("mean_p")), "conv_id", "left")


def threshold_vs_round(spark, sf_dir):
    words = scored(spark, sf_dir)
    return words.groupBy("p").agg(F.count("*").alias("n"), F.min(hard_label(F.col("p"))).alias("rounded"), F.min(named_label(F.col("p"))).alias("named"), F.avg("y").alias("label_rate"))


def parts_as_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts stand for generators: name, price and size give their ids, prices and abilities."""
    text, size = F.array(F.lit("text")), F.col("p_size")
    priced = F.when(size % 11 == 0, F.lit("n/a")).when(size % 13 == 0, F.lit("0")).otherwise((F.floor(F.col("p_retailprice")) / 1000).cast("string"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.when(size % 17 == 0, "~").otherwise(""), F.lower(F.translate("p_brand", "#", "-")), F.lit("/"), F.col("p_partkey").cast("string"), F.when(size % 7 == 0, "-Embed").when(size % 5 == 0, ":free").otherwise("")).alias("id"),
        F.struct(priced.alias("prompt"), priced.alias("completion")).alias("pricing"),
        F.when(size % 3 == 0, F.array(F.lit("top_p"))).otherwise(F.array(F.lit("top_p"), F.lit("max_tokens"))).alias("supported_parameters"),
        F.struct(text.alias("input_modalities"), F.when(size % 19 == 0, F.array(F.lit("text"), F.lit("audio"))).otherwise(text).alias("output_modalities")).alias("architecture"),
        F.when(size % 23 == 0, "2025-01-01").alias("expiration_date"),
    )


def chosen_models(made: DataFrame) -> DataFrame:
    chat = made.where(catalog.is_chat_model())
    return chat.select("id", F.col("pricing.prompt").alias("prompt"), catalog.is_affordable(free_only=True).alias("free"), catalog.is_affordable(most_prompt=1.4, most_completion=1.5).alias("affordable"))


def catalog_filter(spark, sf_dir):
    return chosen_models(parts_as_models(spark, sf_dir))


#: Failures that events stand for: exception, status, text, and the body's message and metadata.
FAILED = [("rate", 429, "too many requests", None, '{"retry_after_seconds": %d}')] * 20 + [
    ("rate", 429, "slow down", "Model is temporarily rate-limited upstream", "{}"),
    ("status", 429, "Error 429", "please RETRY SHORTLY", '{"retry_after_seconds_raw": "soon"}'),
    ("rate", 429, "no more today", "Daily limit reached", "{}"),
    ("status", 429, "limit_rpd exceeded", None, "{}"),
    ("rate", 429, "wait for it", "limit", '{"headers": {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "@late"}}'),
    ("rate", 429, "wait for it", "limit", '{"headers": {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "@soon"}}'),
    ("value", None, "model x returned empty content", None, None),
    ("value", None, "model y Returned No Choices", None, None),
    ("value", None, "Text has 7 words; need at least 30", None, None),
    ("json", None, "returned no choices", None, None),
    ("timeout", None, "timed out", None, None),
    ("runtime", None, "All models unavailable now", None, None),
    ("runtime", None, "something else", None, None),
    ("status", 400, "maximum context is 4096 tokens", None, "{}"),
    ("status", 400, "Provider returned error: context length", None, "{}"),
    ("status", 400, "bad request", None, "{}"),
    ("status", 404, "no such model", None, "{}"),
    ("server", 500, "internal error", "", "{}"),
    ("status", 503, "overloaded", "try another", "{}"),
    ("status", 418, "teapot", None, "[]"),
]


def failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as failures: model, event_id, us, at (seconds), exception, status, text and the body's error."""
    which = draw(7, F.col("event_id"), "kind", below=F.lit(len(FAILED))).cast("int")
    columns = [F.get(F.array(*(F.lit(row[k]) for row in FAILED)), which) for k in range(5)]
    exception, status, text, said, metadata = columns
    at = F.floor(F.col("us") / 1000000)
    filled = F.replace(F.replace(F.replace(metadata, F.lit("%d"), F.col("value").cast("int").cast("string")), F.lit("@late"), ((at + 7200) * 1000).cast("string")), F.lit("@soon"), ((at + 60) * 1000).cast("string"))
    body = F.when(metadata == "[]", metadata).otherwise(F.concat(F.lit('{"error": {"message": "'), F.coalesce(said, F.lit("")), F.lit('", "metadata": '), filled, F.lit("}}")))
    events = table(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("user_id").alias("model"), "event_id", "value", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', cast(ts AS timestamp_ntz))").alias("us"))
    made = once(events, exception=exception, status=status, text=text, body=body, at=at.cast("double")).drop("value")
    return once(made, error=errors.parsed(F.col("body"))).drop("body")


def error_taxonomy(spark, sf_dir):
    rows = failed(spark, sf_dir)
    f = errors.flags(*map(F.col, ("exception", "status", "error", "text", "at")))
    attempt = (F.col("event_id") % 13).cast("int")
    wait = errors.retry_after(errors.retry_value(F.col("error")))
    return rows.select("event_id", errors.message(F.col("error"), F.col("text")).alias("message"), *(c.alias(n) for n, c in f.items()), errors.failure_class(f).alias("kind"), wait.alias("wait"), errors.backoff(f, attempt, wait, F.lit(7.0)).alias("backoff"))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures by class, with the seconds to wait."""
    kind = errors.failure_class(errors.flags(*map(F.col, ("exception", "status", "error", "text", "at"))))
    return once(failed(spark, sf_dir), kind=kind, wait=errors.retry_after(errors.retry_value(F.col("error")))).select("model", "event_id", "us", "at", "kind", "wait")


def cooldown_strikes(spark, sf_dir):
    return cooldown.cooldowns(staged(failures(spark, sf_dir)), ["us", "event_id"]).select("model", "event_id", "kind", "strikes", "until", "permanent", "blocked")


#: Slices that the stream of events comes in, in the order of time.
SLICES = 4


def cooldown_stream(spark, sf_dir):
    """The state of every model after the events have been read as a stream, a slice at a time."""
    base = new_path(spark, "cooldown")
    given = staged(failures(spark, sf_dir))
    part = corpus.key_bucket(given, "us", SLICES)
    rows = given.select("model", (F.col("us") / 1e6).alias("at"), "kind", "wait")
    rows.limit(0).write.parquet(f"{base}/in")
    read = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    changes = cooldown.strikes_stream(read)

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{base}/out")

    for k in range(SLICES):  # what comes is read as it comes; the state goes on from one run to the next
        rows.where(part == k).write.mode("append").parquet(f"{base}/in")
        changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    last = F.max(F.struct("batch", "strikes", "until", "permanent")).alias("s")
    return spark.read.schema("model long, strikes long, until double, permanent boolean, batch int").parquet(f"{base}/out").groupBy("model").agg(last).select("model", "s.strikes", F.round("s.until", 3).alias("until"), "s.permanent")


def available_models(spark, sf_dir):
    """Which of a group's models may be asked at the end of the events, and one drawn from them."""
    last = staged(failures(spark, sf_dir))
    state = cooldown.cooldowns(last, ["us", "event_id"]).groupBy("model").agg(F.max(F.struct("us", "event_id", "until", "permanent", "at")).alias("s"))
    ends = state.select("model", "s.until", "s.permanent", (F.col("model") % 10).alias("part"), F.col("s.at").alias("at"))
    now = ends.groupBy("part").agg((F.max("at") - 40).alias("now"))
    out = cooldown.available(ends.join(now, "part"), F.col("now"), "part")
    return out.withColumn("choice", cooldown.picked(F.col("models"), draw(11, F.col("part"), "model", below=F.lit(1 << 31))))


ALL = [
    word_profile_by_lang, word_profile_by_source_file, shortest_longest_per_group, upper_median_lengths, filtered_index_range, source_point_lookup, prefix_source_match, prefix_source_texts, sentence_segments, prefix_suffix_split, three_part_split,
    append_plan, sandwich_plan, prompt_plan, mixed_labels, conversation_word_labels, label_boundaries, detect_mode_distribution, label_segments, label_segments_whole, one_class_windows, labelled_one_class_windows, boundary_windows, window_audit, merged_split_counts,
    chunk_manifest, chunk_range_prune, subword_label_alignment, subword_label_alignment_whole, padded_label_batches, first_subword_probs, truncation_fallback, confusion_f1, average_precision, reward, model_comparison, document_prob_broadcast, threshold_vs_round, catalog_filter, error_taxonomy, cooldown_strikes, cooldown_stream, available_models,
]
